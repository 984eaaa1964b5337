"""Both sides of every size switch give the same rows."""

import pytest
from conftest import SF001, rows

from lexis.operators import query
from lexis.operators.bm25 import bm25_search
from lexis.operators.boolean import boolean_search, intersect_keep_left, term_lookup
from lexis.operators.index import build_index
from lexis.operators.normalize import lemmatize
from lexis.operators.tokens import parse_queries, tokens
from lexis.operators.topk import with_doc_columns
from lexis.operators.vector import cosine_search
from lexis.profile import LATIN
from lexis.sources.corpus import benchmark_queries, documents
from lexis.sources.stopwords import remove_stop_words, tokens_without


@pytest.fixture(scope="module")
def parts(spark):
    docs = documents(spark, SF001)
    return docs, build_index(docs, LATIN), parse_queries(benchmark_queries(spark, SF001), LATIN)


CASES = {
    "bm25": lambda d, i, q: bm25_search(i, q),
    "cosine": lambda d, i, q: cosine_search(i, q),
    "boolean": lambda d, i, q: boolean_search(i, q),
    "lookup": lambda d, i, q: term_lookup(i, q),
    "intersect": lambda d, i, q: intersect_keep_left(tokens(d, LATIN), q.select("term"), "term"),
    "columns": lambda d, i, q: with_doc_columns(bm25_search(i, q), i.docs, ("n_tokens",)),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_broadcast_or_not(spark, parts, monkeypatch, name):
    want = rows(CASES[name](*parts))
    monkeypatch.setattr(query, "QUERY_BROADCAST_MAX_BYTES", -1)
    assert rows(CASES[name](*parts)) == want and want


def test_words_pushed_into_the_scan_or_not(spark, parts):
    docs, index, _ = parts
    few = parse_queries(spark.createDataFrame([(1, "the of and")], "query_id long, text string"), LATIN)
    want = rows(bm25_search(index, few))
    limit = "spark.sql.parquet.pushdown.inFilterThreshold"
    old = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "0")
        assert rows(bm25_search(index, few)) == want
    finally:
        spark.conf.set(limit, old)


def test_stop_words_and_lemmas(spark, monkeypatch):
    d = spark.createDataFrame([(1, "the cat and the dog"), (2, "the"), (3, None)], "doc_id long, text string")
    stop = spark.createDataFrame([("the",), ("and",), ("the",)], "word string")
    lemma = spark.createDataFrame([("dog", "hound")], "form string, lemma string")
    want = [(1, 0, "cat"), (1, 1, "dog")]
    toks = tokens(d, LATIN)
    for limit in (1 << 20, -1):
        monkeypatch.setattr(query, "QUERY_BROADCAST_MAX_BYTES", limit)
        assert rows(tokens_without(d, LATIN, stop)) == want
        assert rows(tokens_without(d, LATIN, stop, inline_max=0)) == want
        assert rows(remove_stop_words(toks, stop), "doc_id", "pos", "term") == [(1, 1, "cat"), (1, 4, "dog")]
        got = rows(lemmatize(toks, lemma), "doc_id", "pos", "term")
        assert (1, 4, "hound") in got and len(got) == 6
