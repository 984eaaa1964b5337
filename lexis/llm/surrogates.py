"""PII surrogates: keyed, type-consistent replacements, in DataFrame functions.

Detected entities (e-mail, card, phone, IP address, IBAN-like account, secret,
person name with a title, or the words of one again in the same document) are replaced by surrogates of the same form: digits by
digits, letters by letters of the same case and script, punctuation as it is.
IP addresses stay valid, a card that passes the Luhn check gets a surrogate
that does, an e-mail keeps its last two domain labels, a name keeps its title
and the last letters that mark gender.

A surrogate depends on (key, type, normalised entity) only, so all mentions of
an entity, in whatever layout, get the same one (coreference). The entities of
names are their words, so 'Dr. Anna Petrov' and a later 'Petrov' agree. Two entities of
a type must not share a surrogate, and a surrogate must not be a real entity:
the table of distinct entities is checked, and all but the smallest of a
colliding set are drawn again with the next attempt number until none collide;
names and mail addresses, which may be short, get longer as attempts go on.

The entity table is distinct and shuffled by entity; a mention held by a third
of all documents is pre-aggregated there and joined with a skew-safe join.

Defined cases: null texts stay null with no entities; repeated rows get the
same text; overlapping patterns go to the leftmost, then first listed type;
an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import broadcast_if_small, matched, replace_text, saved, whole_rows

KEY = "surrogate-key-1"

TITLE = r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\b\.?"
NAME = rf"\b{TITLE} \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?"
# Where a phone's next group may not start: an IP address, a card.
_OTHER = r"(?!(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b|[0-9]{4}(?:[ \-]?[0-9]{4}){3}\b)"

# Entity types with their patterns, in order of precedence.
TYPES = (
    ("email", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"),
    ("secret", r"(?i:password|passwd|token|secret|api_key|apikey)\s*[=:]\s*[\x22']?[A-Za-z0-9_\-]{12,}"),
    ("ip", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"),
    ("account", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}\b"),
    ("card", r"\b[0-9]{4}(?:[ \-]?[0-9]{4}){3}\b"),
    ("phone", r"\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}\b"
              rf"|\+[0-9]{{1,3}}[ .\-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .\-]?{_OTHER}[0-9]{{2,4}}){{2,4}}\b"
              r"|\([0-9]{3}\) [0-9]{3}-[0-9]{4}\b|\b[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}\b|\b[0-9]{10}\b"),
    ("name", NAME),
)
PATTERN = "|".join(f"(?:{p})" for _, p in TYPES)
GENDER_LETTERS = 1
#: Attempts after which surrogates of names and mail addresses get a letter more.
LONGER_AFTER = 8


def entity_type(raw: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed(TYPES[:-1]):
        out = F.when(raw.rlike(rf"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def normalised(raw: Column, kind: Column) -> Column:
    """What mentions of one entity have in common."""
    return (F.when(kind.isin("phone", "card"), F.regexp_replace(raw, r"[^0-9]", ""))
             .when(kind == "email", F.lower(raw))
             .when(kind == "secret", F.regexp_extract(raw, r"[A-Za-z0-9_\-]{12,}$", 0))
             .when(kind == "name", F.regexp_replace(raw, rf"^{TITLE} ", ""))
             .otherwise(raw))


def _byte(hex_text: Column, i: Column) -> Column:
    """The i-th byte (from 0) of a string of hex digits, as int."""
    return F.conv(F.substring(hex_text, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _letter(letters: str, byte: Column) -> Column:
    return F.substring(F.lit(letters), byte % len(letters) + 1, F.lit(1))


def _mapped(text: Column, stream: Column, keep_last: int = 0, hex_only: bool = False) -> Column:
    """``text`` with every letter and digit replaced from the byte stream."""
    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i % 128)
        low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        cyr = "абвгдежзиклмнопрстуфхцчшэюя"
        kinds = F.when(c.rlike("^[0-9a-f]$"), _letter("0123456789abcdef", b)) if hex_only else F.when(
            c.rlike("^[0-9]$"), _letter("0123456789", b))
        kinds = (kinds.when(c.rlike("^[0-9]$"), _letter("0123456789", b))
                      .when(c.rlike("^[a-z]$"), _letter(low, b)).when(c.rlike("^[A-Z]$"), _letter(up, b))
                      .when(c.rlike("^[а-яё]$"), _letter(cyr, b))
                      .when(c.rlike("^[А-ЯЁ]$"), _letter(cyr.upper(), b))
                      .when(c.rlike(r"^\p{Ll}$"), _letter(low, b)).when(c.rlike(r"^\p{Lu}$"), _letter(up, b)))
        out = kinds.otherwise(c)
        return F.when(i >= F.length(text) - keep_last, c).otherwise(out) if keep_last else out
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits (0 mod 10: valid)."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = F.transform(chars, lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2)
                          .otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x))


def surrogate(kind: Column, norm: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate of a normalised entity."""
    parts = [F.sha2(F.concat_ws("\u0001", F.lit(key), kind, norm, attempt.cast("string"),
                                F.lit(str(i))), 256) for i in range(4)]
    stream = F.concat(*parts)                          # 128 bytes
    local, domain = F.split_part(norm, F.lit("@"), F.lit(1)), F.split_part(norm, F.lit("@"), F.lit(2))
    last_two = F.regexp_extract(domain, r"[^.]+\.[^.]+$", 0)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(last_two))
    # where every draw of this length may be taken, later ones get longer
    extra = F.when(attempt >= LONGER_AFTER, _mapped(
        F.repeat(F.lit("a"), F.floor(attempt / LONGER_AFTER).cast("int")), F.sha2(F.reverse(stream), 512))
    ).otherwise(F.lit(""))
    email = F.concat(_mapped(local, stream), extra, F.lit("@"),
                     _mapped(host, F.sha2(stream, 512)), last_two)
    whole = _mapped(norm, stream, GENDER_LETTERS)
    name = F.concat(F.substring(whole, F.lit(1), F.length(whole) - GENDER_LETTERS), extra,
                    F.right(whole, F.lit(GENDER_LETTERS)))
    octets = F.array(*[(_byte(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    digits = _mapped(norm, stream)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(luhn_sum(norm) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(digits)
    return (F.when(kind == "email", email).when(kind == "ip", F.array_join(octets, "."))
             .when(kind == "card", card)
             .when(kind == "secret", F.when(norm.rlike("^[0-9a-f]+$"), _mapped(norm, stream, hex_only=True))
                   .otherwise(digits))
             .when(kind == "account", F.concat(F.substring(norm, 1, 2),
                                               _mapped(F.substr(norm, F.lit(3)), stream)))
             .when(kind == "name", name).otherwise(digits))


def laid_out(raw: Column, kind: Column, norm: Column, sub: Column) -> Column:
    """The surrogate in the layout of one mention."""
    out = F.array_join(F.aggregate(
        F.filter(F.split(raw, ""), lambda c: c != ""),
        F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("t")),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(
            (s["n"] + 1).alias("n"),
            F.concat(s["t"], F.array(F.substring(sub, s["n"] + 1, F.lit(1)))).alias("t")))
        .otherwise(F.struct(s["n"].alias("n"), F.concat(s["t"], F.array(c)).alias("t"))),
        lambda s: s["t"]), "")
    lead = F.substring(raw, F.lit(1), F.length(raw) - F.length(norm))
    return (F.when(kind.isin("phone", "card"), out)
             .when(kind.isin("secret", "name"), F.concat(lead, sub)).otherwise(sub))


def entity_table(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, sub): distinct entities with surrogates that are distinct
    within a type and are no entity themselves."""
    base = saved(entities.select("kind", "norm").distinct(), "pii-entities")
    done, left, attempt = None, base, 0
    while True:
        drawn = left.withColumn("attempt", F.lit(attempt)).withColumn(
            "sub", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key))
        known = drawn.select("kind", "norm", "sub")
        taken = base.select("kind", F.col("norm").alias("sub"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "sub"))
        first = known.groupBy("kind", "sub").agg(F.min("norm").alias("norm"))
        good = first.join(taken, ["kind", "sub"], "left_anti").select("kind", "norm", "sub")
        good = saved(good if done is None else done.unionByName(good), "pii-surrogates")
        left = saved(base.join(good, ["kind", "norm"], "left_anti"), "pii-open")
        if left.isEmpty():
            return good
        done, attempt = good, attempt + 1


def name_words(text: Column) -> Column:
    """Alternatives to PATTERN: the words of the text's titled names, one or
    two in a row, or an empty string."""
    bare = F.transform(F.regexp_extract_all(text, F.lit(NAME), F.lit(0)),
                       lambda x: F.regexp_replace(x, rf"^{TITLE} ", ""))
    words = F.filter(F.array_distinct(F.flatten(F.transform(bare, lambda x: F.split(x, " ")))),
                     lambda w: ~w.rlike(rf"^{TITLE}$"))
    one = F.concat(F.lit(r"(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}_])"))
    return F.when(F.size(words) > 0, F.concat(
        F.lit(r"|(?<![\p{L}\p{M}\p{N}_])"), one, F.lit("(?: "), one, F.lit(")?"))).otherwise(F.lit(""))


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, and n_entities."""
    rows = whole_rows(docs).withColumn("text", F.col("row.text"))
    found = (rows.where(F.col("text").rlike(PATTERN))
                 .select("doc_id", "text_hash", "text", name_words(F.col("text")).alias("names")))
    raws = F.regexp_extract_all("text", F.concat(F.lit(PATTERN), F.col("names")), F.lit(0))
    found = (found.select("doc_id", "text_hash", "names", F.posexplode(raws).alias("at", "raw"))
                  .dropDuplicates(["doc_id", "text_hash", "at"])
                  .withColumn("kind", entity_type(F.col("raw"))))
    # a name is an entity for each word; its title stays with the first
    whole = normalised(F.col("raw"), F.col("kind"))
    lead = F.when(F.col("kind") == "name", F.substring("raw", F.lit(1), F.length("raw") - F.length(whole)))
    parts = F.transform(F.when(F.col("kind") == "name", F.split(whole, " ")).otherwise(F.array(whole)),
                        lambda w, i: F.struct(w.alias("norm"), F.when(F.col("kind") != "name", F.col("raw")).when(
                            i == 0, F.concat(lead, w)).otherwise(F.concat(F.lit(" "), w)).alias("raw")))
    found = found.select("doc_id", "text_hash", "names", "at", "kind", F.posexplode(parts).alias("nth", "part"))
    found = saved(found.select("doc_id", "text_hash", "names", "at", "nth", "kind", "part.norm", "part.raw"),
                  "pii-mentions")
    table = broadcast_if_small(saved(entity_table(found, key), "pii-table"), 160)
    named = found.join(table, ["kind", "norm"]).withColumn(
        "new", laid_out(F.col("raw"), F.col("kind"), F.col("norm"), F.col("sub")))

    def joined_parts(m: Column, i: Column) -> Column:
        return F.when(m["nth"] == 0, F.concat(m["new"], F.coalesce(F.when(
            F.get("mentions", i + 1)["nth"] == 1, F.get("mentions", i + 1)["new"]), F.lit(""))))
    per_doc = named.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("at", "nth", "new"))).alias("mentions"),
        F.max("names").alias("names"))
    per_doc = per_doc.select("doc_id", "text_hash", "names", F.filter(
        F.transform("mentions", joined_parts), lambda x: x.isNotNull()).alias("new"))
    per_doc = broadcast_if_small(saved(per_doc, "pii-documents"), 512)
    joined = matched(rows, per_doc, "left")
    gaps = F.split("text", F.concat(F.lit(PATTERN), F.col("names")))
    text = F.array_join(F.flatten(F.transform(gaps, lambda g, i: F.when(
        i < F.size("new"), F.array(g, F.get("new", i))).otherwise(F.array(g)))), "")
    return replace_text(joined, F.when(F.col("new").isNotNull(), text).otherwise(F.col("text")),
                        F.coalesce(F.size("new"), F.lit(0)).alias("n_entities"))
