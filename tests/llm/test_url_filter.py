"""URL rules against direct matching; cascades against sets."""

import re

import pytest
from conftest import SF01
from llm.helpers import as_set

from lexis.llm import url_filter as U

URLS = [None, "", "http://net", "http://net/", "http://a.NET/x?y", "x://example.net/en/#", "x://example.net/EN/",
        "://net/", "http://.net/", "a://b.org/fr/\nx", "http://xnet/", "http://a://b.net/", "net/", "http://",
        "https://example.com/de/?q=/", "https://example.com?/de/", "http://m.example.com/de", "http://net:80/",
        "HTTP://EXAMPLE.NET/en/en/", "http://" + "a." * 30_000 + "net/" + "x" * 50_000, "http://É.net/", "http://net."]


def brute(url, rules=U.RULES, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda r: (len(r[0]), r[1] == "block"), default=(None, default))
    return host, path, *best


@pytest.mark.parametrize("rules", [U.RULES, (("net", "", "block"), ("a.net", "/x", "allow"), ("com", "/d", "block")), ()])
def test_awkward_urls(spark, rules):
    rows = [(i, u, "c") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    assert as_set(U.judge_urls(pages, rules)) == sorted(((i, *brute(u, rules)) for i, u, _ in rows), key=repr)


def test_fixture(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    want = sorted(((r["page_id"], *brute(r["url"])) for r in pages.collect()), key=repr)
    assert as_set(U.judge_urls(pages)) == want


def test_empty_table(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


@pytest.mark.parametrize("n_listed", [0, 1, 40, 900])
def test_cascade_is_exact_over_its_universe(spark, n_listed):
    keys = [f"host{i}.example/{i % 7}" for i in range(1000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    listed = spark.createDataFrame([(k,) for k in keys[:n_listed]], "key string")
    levels = U.build_cascade(universe, listed)
    assert U.member(levels, keys).tolist() == [i < n_listed for i in range(1000)]
    assert all(x.bits <= 64 + 40 * max(n_listed, 1) * 2 for x in levels)
