"""Selectors and text on inputs that are harder than the fixture's, against
the standard library's parser."""

import time
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lexis.functions.html import CHUNK_TAGS, Sel, decoded, inner_all, inners, let, links, marked, text
from lexis.sources.pages import SITE_ARTICLE, SITE_LINKS, LinkSpec, extract_articles, extract_links


class Paragraphs(HTMLParser):
    """Texts of p elements inside div.<cls>, counting div depth."""

    def __init__(self, cls):
        super().__init__()
        self.cls, self.depth, self.found, self.open = cls, 0, [], False

    def handle_starttag(self, tag, attrs):
        if tag == "div":
            if self.depth or self.cls in (dict(attrs).get("class") or "").split():
                self.depth += 1
            self.open = False
        elif tag == "p" and self.depth:
            self.found.append("")
            self.open = True

    def handle_endtag(self, tag):
        if tag == "div" and self.depth:
            self.depth -= 1
        if tag in ("p", "div"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.found[-1] += data


PAGES = [
    '<div class="bdaia-post-content"><p>one</p><div><p>two</p></div><p>three</p></div><p>out</p>',
    "<div class='x bdaia-post-content y'><p>a &#1103; &#x41;&amp;#65; &lt;b&gt;</p></div>",
    "<div class=bdaia-post-content><p>bare</p><div class='bdaia-post-content'><p>inner</p></div></div>",
    '<div class="bdaia-post-content-small"><p>no</p></div><div data-class="bdaia-post-content"><p>no</p></div>',
    '<div id="z" class="bdaia-post-content" lang=ru><p>never closed<p>second</div><div><p>out</p></div>',
    '<div class="bdaia-post-content"><p>to the end',
    "", "<p>plain</p>", "<DIV CLASS=\"bdaia-post-content\"><P>Upper</P></DIV>",
]


def test_paragraphs_of_a_container(spark):
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: r.content for r in extract_articles(df, SITE_ARTICLE).collect()}
    for i, h in enumerate(PAGES):
        p = Paragraphs("bdaia-post-content")
        p.feed(h)
        p.close()
        want = " ".join(" ".join(x.split()) for x in p.found if x.strip())
        assert got[i] == want, h


@pytest.mark.parametrize("raw,want", [
    ("a &#65; b", "a A b"), ("&#x1F600;", "\U0001F600"), ("&amp;lt;", "&lt;"), ("&#38;lt;", "&lt;"),
    ("&unknown; &", "&unknown; &"), ("&#0; &#xD800; &#99999999;", "\ufffd \ufffd &#99999999;"),
    ("x&nbsp;&#160;y", "x  y"), ("no reference", "no reference")])
def test_character_references(spark, raw, want):
    assert spark.range(1).select(decoded(F.lit(raw))).first()[0] == want


def test_links_in_any_quotes(spark):
    html = """<h3 class="entry-title big"><a href="https://a/?x=1&amp;y=2"><span>A</span></a></h3>
<h3 class='entry-title'><a rel=x href='https://b/'>B</a></h3><h3 class=entry-title><a href=https://c/>C</a></h3>
<h3 class="entry-title-small"><a href="https://no/">no</a></h3><h3 class="entry-title"><a href="/rel">no</a></h3>"""
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [(r.href, r.title) for r in extract_links(df, SITE_LINKS).orderBy("pos").collect()]
    assert got == [("https://a/?x=1&y=2", "A"), ("https://b/", "B"), ("https://c/", "C")]


def test_first_title_of_a_repeated_link(spark):
    pages = spark.createDataFrame([(1, "https://a/", "")], "page_id long, url string, html string")
    titles = spark.createDataFrame([(1, 0, "https://a/", "Zeta first"), (1, 1, "https://a/", "Alpha second")],
                                   "page_id long, pos int, url string, title string")
    assert extract_articles(pages, SITE_ARTICLE, titles).first().title == "Zeta first"


def test_outermost_elements_in_page_order(spark):
    html = "<nav>1<nav>2</nav>3</nav>x<nav>4</nav></nav><nav>5"
    got = spark.range(1).select(inner_all(F.lit(html), Sel("nav"))).first()[0]
    assert got == ["1<nav>2</nav>3", "4", "5"]
    assert spark.range(1).select(links(F.lit("<a href=x>"), Sel("a", attr="href"))).first()[0] == []
    assert spark.range(1).select(text(F.lit("a<br>b <i>c</i>"))).first()[0] == "a b c"


REFERENCES = ["&eacute;&times;&alpha;", "&lt b &gt", "&copy2024 &notit; &notin; &ampx", "&#65 &#x41 &#150; &#x80;",
              "&CounterClockwiseContourIntegral;", "&nosuch; &;", "&AMP;&AMP", "&NotEqualTilde;", "caf&eacute &Eacutex"]


@pytest.mark.parametrize("raw", REFERENCES)
def test_named_references_of_the_standard(spark, raw):
    assert spark.range(1).select(decoded(F.lit(raw))).first()[0] == unescape(raw)


def page_of(n):
    return "<nav>" + "".join(f'<a href="/{i}">t{i}</a>' for i in range(n)) + "</nav>" + "".join(
        f"<article><p>x{i}</p></article>" for i in range(n))


def test_many_elements_are_all_found(spark):
    n = 3 * CHUNK_TAGS + 7
    df = spark.createDataFrame([(1, "u", page_of(n))], "page_id long, url string, html string")
    links_ = extract_links(df, LinkSpec(Sel("nav"), Sel("a", attr="href", op="^=", value="/"), limit=10**6)).orderBy("pos")
    assert [(r.href, r.title) for r in links_.collect()] == [(f"/{i}", f"t{i}") for i in range(n)]
    got = extract_articles(df).first()
    assert got.content == " ".join(f"x{i}" for i in range(n))
    assert got.keywords == ";".join(f"t{i}" for i in range(n))


def test_time_follows_the_page(spark):
    """Eight times the elements take far less than 64 times as long."""
    def seconds(n):
        df = spark.createDataFrame([(1, "u", page_of(n))], "page_id long, url string, html string")
        began = time.perf_counter()
        assert len(extract_articles(df).first().keywords) > n
        return time.perf_counter() - began

    seconds(1000)
    small, large = min(seconds(2000) for _ in range(2)), seconds(16000)
    assert large < 24 * small + 2


def test_elements_within_containers(spark):
    html = ("<a>out</a><nav><a>1<a>x</a></a><a>2</nav><a>between</a><nav><nav><a>3</a></nav><a>4</a></nav>"
            "<nav><a>5")
    got = spark.range(1).select(let(marked(F.lit(html), Sel("a"), Sel("nav")),
                                    lambda p: inners(p, Sel("a"), Sel("nav")))).first()[0]
    assert got == ["1<a>x</a>", "2", "3", "4", "5"]
    got = spark.range(1).select(links(F.lit('<nav><a href="/1">1<a href="/2">2</a><a href="/3">3</nav>'),
                                      Sel("a", attr="href", op="^=", value="/"), Sel("nav"))).first()[0]
    assert [(r.href, r.inner) for r in got] == [("/1", '1<a href="/2">2')]


def test_blocks_that_never_close(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>a</p></article><script>x " + "<script" * 2000)],
                               "page_id long, url string, html string")
    assert extract_articles(df).first().content == "a"
