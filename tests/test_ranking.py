"""Index statistics and the three SQL-expressible rankings on a tiny corpus,
against formulas written out independently here."""

import math

import pytest
from conftest import rows

from lexis.operators.bm25 import bm25_search
from lexis.operators.boolean import boolean_search, intersect_keep_left, query_plan
from lexis.operators.index import build_index, weighted_postings
from lexis.operators.store import load_index, save_index
from lexis.operators.tokens import parse_queries
from lexis.operators.vector import cosine_search
from lexis.profile import LATIN
from lexis.session import scratch_path

DOCS = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry cherry date"),
        (4, "123 !!!")]
TF = {(1, "apple"): 2, (1, "banana"): 1, (2, "banana"): 1, (2, "cherry"): 1, (3, "cherry"): 3,
      (3, "date"): 1}
LEN = {1: 3, 2: 2, 3: 4}
UNIQUE = {1: 2, 2: 2, 3: 2}
DF = {"apple": 1, "banana": 2, "cherry": 2, "date": 1}
N = 3


@pytest.fixture(scope="module")
def idx(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    return build_index(docs, LATIN)


def q(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    return parse_queries(df, LATIN)


def w(d, t):
    return TF[(d, t)] / LEN[d] * math.log(N / DF[t])


def test_index_tables(spark, idx):
    assert rows(idx.postings, "doc_id", "term", "tf", "n_tokens", "n_unique") == sorted(
        (d, t, c, LEN[d], UNIQUE[d]) for (d, t), c in TF.items())
    assert rows(idx.terms, "term", "df") == sorted(DF.items())
    c = idx.corpus.collect()[0]
    assert (c.n_docs, c.n_tokens, c.n_postings) == (3, 9, 6)   # doc 4 has no token
    assert c.avg_unique == 2.0
    got = {(r.doc_id, r.term): r.tf_idf for r in weighted_postings(idx).collect()}
    assert got == pytest.approx({k: w(*k) for k in TF})


def test_saved_index_equals_lazy_and_is_idempotent(spark, idx):
    path = scratch_path(spark, "t-idx")
    save_index(idx, path)
    b = save_index(idx, path)                 # overwrite: same tables, no duplicates
    for x in (b, load_index(spark, path)):
        assert rows(x.postings) == rows(idx.postings.select(*x.postings.columns))
        assert rows(x.terms) == rows(idx.terms.select(*x.terms.columns))


def test_bm25_reference_variant(spark, idx):
    res = {(r.query_id, r.doc_id): r.score for r in
           bm25_search(idx, q(spark, "banana apple banana")).collect()}
    avg = 2.0

    def idf(t):
        return max(0.0, math.log((N - DF[t] + 0.5) / (DF[t] + 0.5)))

    def part(t, d):
        tf = 1 / UNIQUE[d]
        return idf(t) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * UNIQUE[d] / avg))
    want = {(0, 1): 2 * part("banana", 1) + part("apple", 1), (0, 2): 2 * part("banana", 2)}
    assert res == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("metric", ["cosine", "reference"])
def test_cosine_both_metrics(spark, idx, metric):
    res = {(r.query_id, r.doc_id): r.score for r in
           cosine_search(idx, q(spark, "banana apple banana zzz"), metric=metric).collect()}
    qtf = {"banana": 2, "apple": 1}
    idf = {t: math.log(N / DF[t]) for t in qtf}
    q2 = sum(qtf[t] * idf[t] ** 2 for t in qtf)
    want = {}
    for d in (1, 2):
        dot = sum(qtf[t] * idf[t] * w(d, t) for t in qtf if (d, t) in TF)
        d2 = sum(qtf[t] * w(d, t) ** 2 for t in qtf if (d, t) in TF)
        want[(0, d)] = (dot / (math.sqrt(q2) * math.sqrt(d2)) if metric == "cosine"
                        else dot / math.sqrt(q2) * math.sqrt(d2))
    assert res == pytest.approx(want, abs=1e-9)


def test_zero_norm_gives_zero(spark):
    docs = spark.createDataFrame([(1, "same word"), (2, "same thing")], "doc_id long, text string")
    i = build_index(docs, LATIN)       # "same" is in every document: weight 0
    res = cosine_search(i, q(spark, "same")).collect()
    assert sorted((r.doc_id, r.score) for r in res) == [(1, 0.0), (2, 0.0)]


def test_top_k_ties_by_doc_id(spark):
    docs = spark.createDataFrame([(i, "x y") for i in range(12, 0, -1)], "doc_id long, text string")
    res = bm25_search(build_index(docs, LATIN), q(spark, "x"), k=10).collect()
    assert [r.doc_id for r in sorted(res, key=lambda r: r.rank)] == list(range(1, 11))


def test_boolean_and(spark, idx):
    res = rows(boolean_search(idx, q(spark, "banana cherry", "banana apple", "banana zzz", "",
                                     "123", "Cherry")))
    assert res == [(0, 2), (1, 1), (5, 2), (5, 3)]


def test_every_boolean_hit_is_a_ranked_candidate(spark, idx):
    qs = q(spark, "banana cherry", "apple")
    hits = set(rows(boolean_search(idx, qs)))
    cands = set(rows(bm25_search(idx, qs, k=100).select("query_id", "doc_id")))
    assert hits <= cands


def test_query_plan_rarest_first(spark, idx):
    got = rows(query_plan(idx, q(spark, "banana apple zzz")), "term", "df", "plan_order")
    assert got == [("apple", 1, 2), ("banana", 2, 3), ("zzz", 0, 1)]


def test_semi_join_keeps_left_duplicates(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "term string")
    right = spark.createDataFrame([("a",), ("a",), ("c",)], "term string")
    assert rows(intersect_keep_left(left, right, "term")) == [("a",), ("a",)]


def test_bucketed_index_scores_without_shuffling_candidates(spark, idx):
    saved = save_index(idx, scratch_path(spark, "t-plan"), buckets=4)
    plan = bm25_search(saved, q(spark, "banana apple"))._jdf.queryExecution().executedPlan().toString()
    # The only exchanges left: the tiny query side and the top-k merge.
    head = plan.split("HashAggregate")[0]
    assert "Exchange hashpartitioning(query_id" in head
    assert "Bucketed: true" in plan


def test_fixed_query_side_n(spark, idx):
    """n_docs=30 reproduces the constant N of the ranking being matched on the
    query side only; document weights keep the index's own N."""
    qs = q(spark, "banana apple")
    bm = {r.doc_id: r.score for r in bm25_search(idx, qs, n_docs=30).collect()}

    def part(t, d, n):
        idf = max(0.0, math.log((n - DF[t] + 0.5) / (DF[t] + 0.5)))
        tf = 1 / UNIQUE[d]
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * UNIQUE[d] / 2.0))
    assert bm == pytest.approx({1: part("banana", 1, 30) + part("apple", 1, 30),
                                2: part("banana", 2, 30)}, abs=1e-9)
    cs = {r.doc_id: r.score for r in cosine_search(idx, qs, n_docs=30).collect()}
    idf = {t: math.log(30 / DF[t]) for t in ("banana", "apple")}
    q2 = sum(v * v for v in idf.values())
    dot1 = idf["banana"] * w(1, "banana") + idf["apple"] * w(1, "apple")
    d21 = w(1, "banana") ** 2 + w(1, "apple") ** 2
    assert cs[1] == pytest.approx(dot1 / (math.sqrt(q2) * math.sqrt(d21)), abs=1e-9)


def test_urls_attached_to_top_k(spark):
    from lexis.operators.topk import with_doc_columns
    docs = spark.createDataFrame([(1, "x y", "u1"), (2, "x", "u2"), (3, "z", "u3")],
                                 "doc_id long, text string, url string")
    i = build_index(docs, LATIN, keep=("url",))
    res = with_doc_columns(bm25_search(i, q(spark, "x")), i.docs)
    assert rows(res, "doc_id", "url") == [(1, "u1"), (2, "u2")]


def test_unknown_terms_listed(spark, idx):
    from lexis.operators.boolean import unknown_terms
    assert rows(unknown_terms(idx, q(spark, "banana zzz yyy", "apple"))) == [(0, "yyy"), (0, "zzz")]
