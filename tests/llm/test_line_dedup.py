"""Site-relative line frequency, by hand and by counting."""

import re
from collections import Counter, defaultdict

from llm.helpers import as_set
from pyspark.sql import functions as F

from lexis.llm import line_dedup as L
from lexis.llm.url_filter import url_parts


def clean(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, lines int")
    return L.clean_pages(df, url_parts("url")[0], L.html_lines("html"), **options)


def page(i, host, *lines):
    return (i, f"http://{host}/{i}", "<p>" + "</p><p>".join(lines) + "</p>", "x", 1)


def test_lines_of_a_page(spark):
    html = "<html><script>a<b</script><p>One <b>two</b></p>\n<!-- no\n --> three <div>four</div>&amp; <STYLE>x</STYLE>"
    got = spark.createDataFrame([(html,), (None,), ("",)], "html string").select(L.html_lines("html")).collect()
    assert [r[0] for r in got] == [["One two", "three", "four", "&amp;"], [], []]


def test_ratio_is_of_the_host_and_ties_stay(spark):
    rows = [page(i, "a.org", "menu", f"body {i}", "half" if i % 2 else f"u{i}") for i in range(10)]
    rows += [page(20 + i, "B.org", "menu" if i == 0 else f"x{i}", f"b{i}") for i in range(10)]
    got = {r["page_id"]: r for r in clean(spark, rows, max_ratio=0.5).collect()}
    assert got[1]["text"] == "body 1\nhalf" and got[1]["n_dropped"] == 1 and got[1]["n_lines"] == 3
    assert got[20]["text"] == "menu\nb0" and got[20]["host"] == "b.org"


def test_against_counting(spark):
    import random
    rng = random.Random(2)
    rows = [page(i, "hot" if i % 3 else f"h{i % 5}", *[f"l{rng.randint(0, 12)}" for _ in range(rng.randint(0, 6))])
            for i in range(300)]
    lines = {r[0]: [x for x in re.split("<[^<>]*>", r[2]) if x] for r in rows}
    hosts = {r[0]: re.match("http://([^/]*)", r[1]).group(1) for r in rows}
    total, seen = Counter(hosts.values()), defaultdict(set)
    for i, ls in lines.items():
        for x in ls:
            seen[hosts[i], x].add(i)
    bad = {k for k, v in seen.items() if len(v) >= 3 and len(v) > 0.25 * total[k[0]]}
    want = sorted(((i, "\n".join(x for x in ls if (hosts[i], x) not in bad)) for i, ls in lines.items()), key=repr)
    assert as_set(clean(spark, rows, max_ratio=0.25, min_pages=3), "page_id", "text") == want
    bad = {k for k, v in seen.items() if len(v) > 0.25 * total[k[0]]}
    want = sorted(((i, "\n".join(x for x in ls if (hosts[i], x) not in bad)) for i, ls in lines.items()), key=repr)
    assert as_set(clean(spark, rows, max_ratio=0.25), "page_id", "text") == want


def test_both_sides_of_the_broadcast_switch(spark, monkeypatch):
    rows = [page(i, "a.org", "menu", f"body {i}") for i in range(10)]
    want = as_set(clean(spark, rows))
    import lexis.llm.common as C
    monkeypatch.setattr(C, "BROADCAST_BYTES", -1)
    assert as_set(clean(spark, rows)) == want


def test_awkward_rows(spark):
    rows = [(1, None, None, "x", 1), (2, "http://h/", "", "x", 1), (3, "http://h/", "<p>a</p>", "x", 1),
            (3, "http://h/", "<p>a</p>", "x", 1), (None, "no url", "text", "x", 1),
            (4, "http://h/", "<p>" + "y " * 50_000 + "</p><p>a", "x", 1)]
    got = as_set(clean(spark, rows, max_ratio=0.5, min_pages=3), "page_id", "host", "n_lines", "n_dropped")
    assert got == sorted([(1, "", 0, 0), (2, "h", 0, 0), (3, "h", 1, 1), (3, "h", 1, 1), (None, "", 1, 0),
                          (4, "h", 2, 1)], key=repr)
    assert clean(spark, rows[:0]).count() == 0
    assert spark.range(1).select(L.text_lines(F.lit("a\n\n b "))).first()[0] == ["a", "b"]


def test_copies_that_differ_in_white_space_at_their_ends_are_one_line(spark):
    ends = [("", ""), ("\t", ""), ("", "\r"), (" \x0b\f", "\t\r"), ("\t ", " ")]
    rows = [page(i, "a.org", a + "menu" + b, f"body\t{i}\r") for i, (a, b) in enumerate(ends)]
    got = clean(spark, rows, max_ratio=0.9).collect()
    assert {(r["page_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got} == {
        (i, 2, 1, f"body\t{i}\r") for i in range(5)}


def test_the_ratio_alone_decides_by_default(spark):
    rows = [page(1, "one.org", "only"), *[page(i, "two.org", "menu", f"b{i}") for i in (2, 3)]]
    got = {r["page_id"]: r["text"] for r in clean(spark, rows, max_ratio=0.5).collect()}
    assert got == {1: "", 2: "b2", 3: "b3"}


def test_twin_compares_lines_as_the_operator(spark, tmp_path):
    """Lines that end in tabs, and columns with the operators' own names."""
    import duckdb

    from lexis.llm import registry
    rows = [(i, f"http://h{i % 2}/", f"<p>\tmenu{' ' * i}\t</p><p>own {i}\t</p>", "x", 1, 2, 3) for i in range(24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, lines int, digests int, key int")
    df.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cur = con.execute(registry.ORACLE_SQL["op3_line_dedup"])
    cols = [c[0] for c in cur.description]
    got = registry.QUERIES["op3_line_dedup"](spark, str(tmp_path))
    want = sorted(cur.fetchall(), key=repr)
    assert as_set(got, *cols) == want
    assert all(r[3] == 1 for r in want)
