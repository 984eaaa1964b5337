"""LSA against a brute-force numpy version of the matched algorithm.

Brute force, per query: the terms x documents tf-idf matrix over all
dictionary terms (only query-term rows non-zero) and the candidate
documents; full SVD; keep k = min(5, rank) values; q_k = q U_k S_k^-1 with
q = 1 on known query words; documents = rows of V_k; score by the chosen
measure; top 10 by score, then doc_id.
"""

import math

import numpy as np
import pytest
from conftest import SF001

from lexis.functions.scoring import SCORE_DIGITS
from lexis.operators.index import build_index, weighted_postings
from lexis.operators.store import save_index
from lexis.operators.lsa import LSA_RCOND, lsa_search
from lexis.operators.tokens import parse_queries
from lexis.profile import LATIN
from lexis.session import scratch_path
from lexis.sources.corpus import benchmark_queries, documents


def brute_force(wp, qterms, metric, k=5, top=10):
    """wp: {(doc, term): w}; qterms: {query_id: set(terms)} -> {qid: [(doc, score)]}."""
    vocab = sorted({t for _, t in wp})
    row = {t: i for i, t in enumerate(vocab)}
    out = {}
    for qid, words in qterms.items():
        known = [t for t in words if t in row]
        docs = sorted({d for (d, t) in wp if t in set(known)})
        if not docs:
            out[qid] = []
            continue
        a = np.zeros((len(vocab), len(docs)))
        for j, d in enumerate(docs):
            for t in known:
                a[row[t], j] = wp.get((d, t), 0.0)
        u, s, vt = np.linalg.svd(a, full_matrices=False)
        kk = sum(1 for c in range(min(k, len(s))) if s[c] > 0 and s[c] >= LSA_RCOND * s[0])
        if kk == 0:                     # every weight is zero: all at the origin
            out[qid] = [(d, 0.0) for d in docs][:top]
            continue
        q = np.zeros(len(vocab))
        for t in known:
            q[row[t]] = 1.0
        qk = q @ u[:, :kk] / s[:kk]
        v = vt[:kk, :].T
        scored = []
        for j, d in enumerate(docs):
            dv = v[j]
            dot, q2, d2 = float(qk @ dv), float(qk @ qk), float(dv @ dv)
            if metric == "cosine":
                sc = dot / (math.sqrt(q2) * math.sqrt(d2)) if q2 and d2 else 0.0
            else:
                sc = (dot / math.sqrt(q2) if q2 else 0.0) * math.sqrt(d2)
            scored.append((d, round(sc, SCORE_DIGITS)))
        scored.sort(key=lambda x: (-x[1], x[0]))
        out[qid] = scored[:top]
    return out


@pytest.fixture(scope="module")
def setup(spark):
    idx = save_index(build_index(documents(spark, SF001), LATIN), scratch_path(spark, "t-lsa"))
    q = parse_queries(benchmark_queries(spark, SF001), LATIN)
    wp = {(r.doc_id, r.term): r.tf_idf for r in weighted_postings(idx).collect()}
    qterms = {}
    for r in q.collect():
        qterms.setdefault(r.query_id, set()).add(r.term)
    return idx, q, wp, qterms


@pytest.mark.parametrize("metric", ["cosine", "reference"])
def test_lsa_matches_numpy_svd(spark, setup, metric):
    idx, q, wp, qterms = setup
    want = brute_force(wp, qterms, metric)
    got = {}
    for r in lsa_search(idx, q, metric=metric).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
    assert set(got) == {k for k, v in want.items() if v}
    for qid, res in got.items():
        res.sort()
        w = want[qid]
        assert len(res) == len(w)
        for (rank, doc, score), (wdoc, wscore) in zip(res, w):
            assert score == pytest.approx(wscore, abs=1e-6), (qid, rank)
        # Same documents up to exact score ties at the cut.
        assert {d for _, d, _ in res} <= {d for d, s in w} | {
            d for (d, _), s2 in zip(w, [x[1] for x in w]) if s2 == w[-1][1]}


def test_rank_deficient_query_keeps_nonzero_values(spark):
    """Two query words -> rank <= 2 < 5: the cut falls to the rank, no error."""
    from lexis.operators.index import build_index as bi
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma"), (2, "alpha alpha delta"), (3, "beta epsilon"), (4, "zeta")],
        "doc_id long, text string")
    qs = spark.createDataFrame([(7, "alpha beta")], "query_id long, text string")
    idx = bi(docs, LATIN)
    res = lsa_search(idx, parse_queries(qs, LATIN), metric="cosine").collect()
    assert sorted(r.doc_id for r in res) == [1, 2, 3]
    wp = {(r.doc_id, r.term): r.tf_idf for r in weighted_postings(idx).collect()}
    want = brute_force(wp, {7: {"alpha", "beta"}}, "cosine")[7]
    got = sorted((r.doc_id, r.score) for r in res)
    assert [d for d, _ in got] == [d for d, _ in sorted(want)]
    assert [s for _, s in got] == pytest.approx([s for _, s in sorted(want)], abs=1e-6)


@pytest.mark.parametrize("word", ["aaa", "zzz"])
@pytest.mark.parametrize("metric", ["cosine", "reference"])
def test_a_word_of_every_document_loses_no_candidates(spark, word, metric):
    docs = spark.createDataFrame([(1, f"{word} kiwi"), (2, f"{word} lime kiwi"), (3, word), (4, f"{word} plum")],
                                 "doc_id long, text string")
    idx = build_index(docs, LATIN)
    q = parse_queries(spark.createDataFrame([(1, f"{word} kiwi")], "query_id long, text string"), LATIN)
    got = {r.doc_id for r in lsa_search(idx, q, metric=metric).collect()}
    assert got == {1, 2, 3, 4}


def test_small_memory_budget_changes_nothing(spark, monkeypatch):
    from lexis.operators import lsa
    idx = build_index(documents(spark, SF001), LATIN)
    q = parse_queries(benchmark_queries(spark, SF001), LATIN)
    want = lsa_search(idx, q, metric="cosine").collect()
    monkeypatch.setattr(lsa, "GRAM_BYTES", 20_000)
    monkeypatch.setattr(lsa, "CELLS_PER_BATCH", 100)
    got = lsa_search(idx, q, metric="cosine").collect()
    key = lambda r: (r.query_id, r.rank)
    for a, b in zip(sorted(want, key=key), sorted(got, key=key)):
        assert a.doc_id == b.doc_id and abs(a.score - b.score) < 1e-7
