"""BM25 by blocks with score bounds: the rows of the full search, from fewer postings."""

import numpy as np
import pytest
from conftest import SF001, rows

from lexis.operators.bm25 import bm25_idf_table, bm25_search
from lexis.operators.bounds import block_postings, blocks_to_read, bounded_search, store_bounded
from lexis.operators.index import build_index, materialize
from lexis.operators.tokens import parse_queries
from lexis.profile import LATIN
from lexis.session import scratch_path
from lexis.sources.corpus import benchmark_queries, documents


def indexed(spark, docs):
    return materialize(build_index(docs, LATIN), scratch_path(spark, "t-bounds"))


def batch(spark, *texts):
    return parse_queries(spark.createDataFrame(list(enumerate(texts)), "query_id long, text string"), LATIN)


@pytest.fixture(scope="module")
def zipf(spark):
    """1,500 documents of 5 to 400 words, words as uneven as in texts."""
    rng = np.random.default_rng(3)
    vocab = np.array([f"w{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"])
    docs = [(d, " ".join(vocab[np.minimum(rng.zipf(1.3, int(rng.integers(5, 400))), 512) - 1])) for d in range(1500)]
    return indexed(spark, spark.createDataFrame(docs, "doc_id long, text string"))


@pytest.mark.parametrize("block_docs", [20, 10_000])
def test_equals_the_full_search(spark, zipf, block_docs):
    bounded = store_bounded(zipf, scratch_path(spark, "t-blocks"), block_docs)
    q = batch(spark, "waaa waab", "waad wbbc whhh", "wbaa wbec wccc", "whgc", "unheard", "waaa waaa wabc unheard", "")
    for k in (1, 10, 2000):
        assert rows(bounded_search(zipf, bounded, q, k)) == rows(bm25_search(zipf, q, k))


def test_fewer_postings_are_read(spark, zipf):
    bounded = store_bounded(zipf, scratch_path(spark, "t-blocks"), 20)
    q = bm25_idf_table(zipf, batch(spark, "wbaa wbec wccc"), small=True)
    chosen = blocks_to_read(bounded, q, 10, True)
    read = block_postings(bounded, q, chosen, True).count()
    held = bounded.postings.join(q, "term").count()
    assert bounded.bounds.join(q, "term").count() < held
    print("postings read, held:", read, held)
    assert 0 < read < 0.5 * held


def test_a_block_is_bounded_in_documents_and_by_its_bound(spark, zipf):
    bounded = store_bounded(zipf, scratch_path(spark, "t-blocks"), 50)
    per = bounded.postings.groupBy("block").agg({"doc_id": "count"})
    assert bounded.postings.count() == zipf.postings.count() and per.count() > 30
    low = {(r.term, r.block): r.least_unique for r in bounded.bounds.collect()}
    assert all(r.n_unique >= low[(r.term, r.block)] for r in bounded.postings.collect())


def test_the_benchmark_batch(spark):
    idx = indexed(spark, documents(spark, SF001))
    bounded, q = store_bounded(idx, scratch_path(spark, "t-blocks"), 10), parse_queries(benchmark_queries(spark, SF001), LATIN)
    assert rows(bounded_search(idx, bounded, q)) == rows(bm25_search(idx, q))


def test_empty_tables_and_words_without_weight(spark):
    empty = indexed(spark, spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"))
    assert bounded_search(empty, store_bounded(empty, scratch_path(spark, "t-blocks")), batch(spark, "a")).count() == 0
    # a word of every document weighs nothing: ties go by doc_id, from all blocks
    same = indexed(spark, spark.createDataFrame([(d, "same " * (d % 7 + 1)) for d in range(40)], "doc_id long, text string"))
    bounded = store_bounded(same, scratch_path(spark, "t-blocks"), 3)
    got = bounded_search(same, bounded, batch(spark, "same"), 5)
    assert [(r["rank"], r.doc_id, r.score) for r in got.orderBy("rank").collect()] == [(i + 1, i, 0.0) for i in range(5)]


def test_parameters_that_break_the_bound_are_refused(spark, zipf):
    bounded = store_bounded(zipf, scratch_path(spark, "t-blocks"))
    for wrong in ({"k1": -0.1}, {"b": 1.5}):
        with pytest.raises(ValueError):
            bounded_search(zipf, bounded, batch(spark, "waaa"), **wrong)
