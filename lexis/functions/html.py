"""HTML as column expressions: pick elements, take their text.

No HTML parser: pages are handled by regular expressions on the raw string,
inside the JVM. The patterns are plain strings so the DuckDB check can use
the very same ones. Supported selectors: a tag name with at most one
condition -- a class (``div.tagcloud``), an attribute equal to a value
(``a[rel=tag]``) or starting with a prefix (``a[href^=https://]``). Attribute
values may be in double, single or no quotes; a class is one of the tokens of
its attribute; containers end where their own close tag is, whatever is
nested in them; all named references of HTML and numeric ones are decoded.

A page is cut into tags once (``marked``); folds over the tags with a running
depth give the ranges of the elements (``ranges``), and their inner HTML is
joined from the cut pieces (``inner``). Every step takes time in proportion to
the page. A value that a lambda needs is bound by ``let``, since an expression
that stands inside a lambda is computed again for each element.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
# Start tags that end an open paragraph (HTML parsing rules).
P_CLOSERS = ("address article aside blockquote details div dl fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
             "table ul").split()
# The commonest named character references; &amp; goes last so that, where
# they are replaced one after the other, "&amp;lt;" becomes "&lt;" and not "<".
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
            ("&nbsp;", " "), ("&copy;", "\u00a9"), ("&reg;", "\u00ae"), ("&middot;", "\u00b7"),
            ("&laquo;", "\u00ab"), ("&raquo;", "\u00bb"), ("&ndash;", "\u2013"),
            ("&mdash;", "\u2014"), ("&lsquo;", "\u2018"), ("&rsquo;", "\u2019"),
            ("&ldquo;", "\u201c"), ("&rdquo;", "\u201d"), ("&hellip;", "\u2026"),
            ("&euro;", "\u20ac"), ("&trade;", "\u2122"), ("&amp;", "&"))
# Characters folded to one space in element text (no-break space included).
TEXT_SPACE = r"[ \t\n\f\r\x{A0}]+"
# ---------------------------------------------------------------------------

# A block that is never closed ends with the page.
DROP_BLOCKS = (r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|"
               r"<!--.*?(?:-->|\z)")
BR = r"(?i)<br\b[^>]*>"
ANY_TAG = r"(?s)<[^>]*>"
# Tags of a chunk. A fold copies its state at every step, so no state may grow
# with the page: one fold over the chunks notes the state each starts with, and
# each chunk's own fold collects its ranges.
CHUNK_TAGS = 128

# All named references (the standard's table, as Python has it), the commonest
# first: names that end with a semicolon, and the old names that may stand
# without one. Numeric references from 128 to 159 mean characters of Windows-1252.
REFERENCES = ({e[1:-1]: c for e, c in ENTITIES} | {"#160": " "}
              | {f"#{c}": w for c in range(128, 160) if (w := bytes([c]).decode("cp1252", "ignore"))}
              | {n.removesuffix(";"): c for n, c in html5.items() if n != "nbsp;" and n != "nbsp"})
OLD_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_TABLE = "\x01".join(f"{n}\x02{c}" for n, c in REFERENCES.items())


@dataclass(frozen=True)
class Sel:
    """``tag``, ``tag.cls``, ``tag[attr=value]`` or ``tag[attr^=prefix]``."""
    tag: str
    cls: str | None = None
    attr: str | None = None
    op: str = "="
    value: str = ""

    def open_tag(self, capture_attr: bool = False) -> str:
        """Regex for the start tag. With ``capture_attr`` the attribute value,
        in its quotes if it has any, is group 1."""
        if self.cls:
            c = re.escape(self.cls)
            return (rf"<{self.tag}\b[^>]*?\sclass\s*=\s*(?:"
                    rf'"(?:[^"]*\s)?{c}(?:\s[^"]*)?"[^>]*|'
                    rf"'(?:[^']*\s)?{c}(?:\s[^']*)?'[^>]*|{c}(?:\s[^>]*)?)>")
        if self.attr:
            v, more = re.escape(self.value), self.op == "^="
            quoted = (rf'"{v}[^"]*"|\'{v}[^\']*\'|{v}[^\s"\'>]*' if more else
                      rf'"{v}"|\'{v}\'|{v}')
            group = f"({quoted})" if capture_attr else f"(?:{quoted})"
            return rf"<{self.tag}\b[^>]*?\s{re.escape(self.attr)}\s*=\s*{group}(?:[\s/][^>]*)?>"
        return rf"<{self.tag}\b[^>]*>"

    def element(self) -> str:
        """Regex for a whole element; inner HTML is the last group."""
        return rf"(?is){self.open_tag()}(.*?)</{self.tag}\s*>"

    def link(self) -> str:
        """Regex for an element with its attribute value (group 1) and inner
        HTML (group 2)."""
        return rf"(?is){self.open_tag(capture_attr=True)}(.*?)</{self.tag}\s*>"


def paragraph_split(tag: str = "p") -> str:
    return rf"(?i)<{tag}\b[^>]*>"


def paragraph_cut(tag: str = "p") -> str:
    """From the paragraph's end (its close tag or a start tag that closes it)
    to the end of the piece."""
    closers = "|".join(P_CLOSERS)
    return rf"(?is)(?:</{tag}\s*>|<(?:{closers})\b).*$"


# --- Spark column expressions ---------------------------------------------

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body,
    or a lambda in it, names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean(html: Column) -> Column:
    """Drop scripts, styles and comments (a script may hold a fake tag)."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), DROP_BLOCKS, "")


def _reference(part: Column) -> Column:
    """One piece of text: a character reference decoded, else as it is.
    Code points that name no character become U+FFFD. Without a semicolon only
    the old names count, the longest that the piece starts with."""
    digits = F.regexp_extract(part, r"^&#([0-9]{1,7});?$", 1)
    hexes = F.regexp_extract(part, r"(?i)^&#x([0-9a-f]{1,6});?$", 1)
    code = F.when(digits != "", digits.cast("int")).when(hexes != "", F.conv(hexes, 16, 10).cast("int"))
    table = F.str_to_map(F.lit(_TABLE), F.lit("\x01"), F.lit("\x02"))

    def numeric(c):
        valid = c.between(1, 0xD7FF) | c.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        return F.coalesce(F.when(c.between(128, 160), F.try_element_at(table, F.concat(F.lit("#"), c.cast("string")))),
                          F.when(c.isNotNull(), char))

    def named(name):
        old = F.regexp_extract(name, "^(?:" + "|".join(OLD_NAMES) + ")", 0)
        lenient = F.when(old != "", F.concat(F.try_element_at(table, old), name.substr(F.length(old) + 1, F.length(name))))
        whole = F.when(name.endswith(";"), F.try_element_at(table, F.rtrim(name, F.lit(";"))))
        return F.coalesce(whole, lenient, part)

    return (F.when(~part.startswith("&"), part).when(part.startswith("&#"), F.coalesce(let(code, numeric), part))
             .otherwise(let(F.substring(part, 2, 1 << 30), named)))


def decoded(s: Column) -> Column:
    """Character references decoded, each once."""
    parts = F.regexp_extract_all(
        s, F.lit(r"(?i)(?s)&(?:#x[0-9a-f]+;?|#[0-9]+;?|[a-z][a-z0-9]*;?)|[^&]+|&"), F.lit(0))
    return F.when(F.contains(s, F.lit("&")), F.array_join(F.transform(parts, _reference), "")).otherwise(s)


def text(fragment: Column) -> Column:
    """Element text: line breaks to spaces, tags off, references decoded,
    whitespace folded and trimmed."""
    t = F.regexp_replace(fragment, BR, " ")
    t = decoded(F.regexp_replace(t, ANY_TAG, ""))
    return F.trim(F.regexp_replace(t, TEXT_SPACE, " "))


def marked(html: Column, *sels: Sel | None) -> Column:
    """struct<tags, gaps>: the page cut at every start and end tag of the
    selectors' kinds; gap k (from 0) stands after tag k (from 1)."""
    kinds = "|".join(sorted({s.tag.lower() for s in sels if s is not None}))
    pattern = rf"(?is)</(?:{kinds})\s*>|<(?:{kinds})\b[^>]*>"
    return F.struct(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)).alias("tags"),
                    F.split(html, pattern).alias("gaps"))


def _events(tags: Column, sel: Sel) -> Column:
    """For each tag: 0 of another kind, 1 an end tag, 2 a start tag, 3 a start
    tag that ``sel`` selects."""
    def event(t):
        other = ~t.rlike(rf"(?i)^</?{sel.tag}\b")
        return F.when(other, 0).when(t.startswith("</"), 1).when(t.rlike(rf"(?is)^{sel.open_tag()}$"), 3).otherwise(2)
    return F.transform(tags, event)


def ranges(page: Column, sel: Sel, within: Sel | None = None, nested: bool = True) -> Column:
    """array<struct<o, a, b>>: the outermost elements of a marked page that
    ``sel`` selects, in page order, as the numbers of their start and end tags.
    With ``within`` only those inside outermost elements of that selector,
    which ``o`` numbers from 1.

    An element that is never closed ends with what holds it. With ``nested``
    false the first end tag closes an element, and an element without one is
    left out.
    """
    none = F.array().cast("array<struct<o:int,a:int,b:int>>")
    state = "struct<n:int,outer:int,o:int,depth:int,a:int>"
    start = F.struct(F.lit(0).alias("n"), F.lit(int(within is None)).alias("outer"), F.lit(0).alias("o"),
                     F.lit(0).alias("depth"), F.lit(0).alias("a"))

    def holder(s, w):
        """Depth in what holds the elements, after the tag."""
        outer = s["outer"]
        if within is None:
            return outer
        return (F.when(outer > 0, outer + F.when(w == 1, -1).when(w >= 2, 1).otherwise(0))
                 .when(w == 3, F.lit(1)).otherwise(outer))

    def deeper(s, e, held):
        """Depth in the element, after the tag; the start tag of what holds
        elements is not one of them."""
        depth = s["depth"]
        if nested:
            on = depth + F.when(e == 1, -1).when(e >= 2, 1).otherwise(0)
        else:
            on = F.when(e == 1, 0).otherwise(1)
        begins = (s["outer"] > 0) & (e == 3)
        return F.when(held == 0, 0).when(depth > 0, on).when(begins, 1).otherwise(0)

    def after(s, e):
        held = holder(s, e["w"])
        depth = deeper(s, e["e"], held)
        return F.struct(
            (s["n"] + 1).alias("n"), held.alias("outer"),
            (s["o"] + F.when((s["outer"] == 0) & (held == 1), 1).otherwise(0)).alias("o"), depth.alias("depth"),
            F.when((s["depth"] == 0) & (depth == 1), s["n"] + 1).otherwise(s["a"]).alias("a")).cast(state)

    def collect(f, e):
        now = f["s"]
        end = (now["depth"] > 0) & (deeper(now, e["e"], holder(now, e["w"])) == 0)
        if not nested:
            end = end & (e["e"] == 1)
        one = F.array(F.struct(now["o"].alias("o"), now["a"].alias("a"), (now["n"] + 1).alias("b")))
        return F.struct(after(now, e).alias("s"), F.when(end, F.concat(f["r"], one)).otherwise(f["r"]).alias("r"))

    def found(events):
        chunks = F.sequence(F.lit(0), F.greatest(F.ceil((F.size(events) - 1) / CHUNK_TAGS).cast("int"), F.lit(0)))

        def chunk(k):
            return F.slice(events, k * CHUNK_TAGS + 1, F.lit(CHUNK_TAGS))

        opening = F.struct(start.cast(state).alias("s"), F.array().cast(f"array<{state}>").alias("at"))
        states = F.aggregate(chunks, opening, lambda f, k: F.struct(
            F.aggregate(chunk(k), f["s"], after).alias("s"), F.concat(f["at"], F.array(f["s"])).alias("at")))

        def collected(f):
            each = F.transform(f["at"], lambda s, k: F.aggregate(
                chunk(k), F.struct(s.alias("s"), none.alias("r")), collect)["r"])
            last, s = F.array(F.struct(f["s"]["o"].alias("o"), f["s"]["a"].alias("a"),
                                       (f["s"]["n"] + 1).alias("b"))), f["s"]
            rest = F.when((s["depth"] > 0) & F.lit(nested), last).otherwise(none)
            return F.concat(F.flatten(each), rest)

        return let(states, collected)

    outer = _events(page["tags"], within) if within is not None else F.transform(page["tags"], lambda t: F.lit(0))
    return let(F.zip_with(outer, _events(page["tags"], sel), lambda w, e: F.struct(w.alias("w"), e.alias("e"))), found)


def inner(page: Column, r: Column) -> Column:
    """Inner HTML of one range of a marked page: gaps a .. b - 1 with the tags
    between them."""
    held = F.slice(page["gaps"], r["a"] + 1, r["b"] - r["a"])
    between = F.slice(page["tags"], r["a"] + 1, F.greatest(r["b"] - r["a"] - 1, F.lit(0)))
    return F.array_join(F.zip_with(held, between, lambda g, t: F.concat(g, F.coalesce(t, F.lit("")))), "")


def inners(page: Column, sel: Sel, within: Sel | None = None) -> Column:
    """Inner HTML of every range of a marked page."""
    return F.transform(ranges(page, sel, within), lambda r: inner(page, r))


def first(page: Column, sel: Sel) -> Column:
    """Inner HTML of the first range, empty if there is none."""
    return F.coalesce(F.get(F.transform(F.slice(ranges(page, sel), 1, 1), lambda r: inner(page, r)), F.lit(0)),
                      F.lit(""))


def inner_all(html: Column, sel: Sel) -> Column:
    """Inner HTML of every outermost element matching ``sel``, in page order.
    An element that is never closed ends with the page."""
    return let(marked(html, sel), lambda page: inners(page, sel))


def inner_first(html: Column, sel: Sel) -> Column:
    return let(marked(html, sel), lambda page: first(page, sel))


def paragraphs(container_inner: Column, tag: str = "p") -> Column:
    """Texts of the paragraphs of one container, empty ones dropped.

    Split on each paragraph start and cut every piece where the paragraph
    ends: a close tag, a block start that closes it, or the container's end
    (unclosed paragraphs are common).
    """
    body = let(F.split(container_inner, paragraph_split(tag)),
               lambda pieces: F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))))
    texts = F.transform(body, lambda s: text(F.regexp_replace(s, paragraph_cut(tag), "")))
    return F.filter(texts, lambda s: s != "")


def links(html: Column, sel: Sel, within: Sel | None = None) -> Column:
    """array<struct<href, inner>> of elements matching ``sel`` (an attribute
    selector), in page order; a link ends at the first end tag."""
    def one(page, r):
        value = F.regexp_extract(page["tags"][r["a"] - 1], rf"(?is)^{sel.open_tag(capture_attr=True)}$", 1)
        return F.struct(decoded(F.regexp_replace(value, "^[\"']|[\"']$", "")).alias("href"),
                        inner(page, r).alias("inner"))

    return let(marked(html, sel, within),
               lambda page: F.transform(ranges(page, sel, within, nested=False), lambda r: one(page, r)))
