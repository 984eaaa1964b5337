"""Triangular factors of the LSA matrices: exact where A^T A is not."""

import numpy as np
import pytest

from lexis.operators import lsa
from lexis.operators.lsa import factor_table, triangular_factors

ENTRIES = "query_id long, doc_id long, ti int, w double"


def entries(spark, matrices, parts=5):
    rows = [(q, int(d), int(t), float(m[d, t])) for q, m in matrices.items() for d, t in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, ENTRIES).repartition(parts, "query_id", "doc_id")


def r_of(factors):
    acc = {}
    for row in factors.collect():
        lsa._add_rows(acc, row.query_id, np.frombuffer(row.r, "<f8").reshape(-1, row.t))
    return acc


def graded(rows, cols, least, seed):
    """Singular values falling from 1 to ``least``, entries all non-zero."""
    rng = np.random.default_rng(seed)
    u, _ = np.linalg.qr(rng.standard_normal((rows, cols)))
    v, _ = np.linalg.qr(rng.standard_normal((cols, cols)))
    return u * np.logspace(0, np.log10(least), cols) @ v.T


@pytest.mark.parametrize("budget", [None, 2_000])
def test_singular_values_to_rounding(spark, monkeypatch, budget):
    if budget:                                             # many small blocks, factors sent early
        monkeypatch.setattr(lsa, "GRAM_BYTES", budget)
    ms = {1: graded(300, 12, 1e-9, 1), 2: graded(40, 30, 1e-6, 2), 3: np.ones((1, 4)), 4: graded(7, 3, 1, 4)[:, ::-1]}
    got = r_of(triangular_factors(entries(spark, ms)))
    for q, m in ms.items():
        s, want = np.linalg.svd(got[q], compute_uv=False), np.linalg.svd(m, compute_uv=False)
        k = min(len(s), len(want))
        assert np.abs(s[:k] - want[:k]).max() < 1e-14 * want[0]
        assert np.allclose(s[k:], 0)
    # the Gram route loses the smallest of the first matrix
    lost = np.sqrt(np.clip(np.linalg.eigvalsh(ms[1].T @ ms[1]), 0, None)).min()
    kept = np.linalg.svd(got[1], compute_uv=False).min()
    assert abs(kept - 1e-9) < 1e-14 < abs(lost - 1e-9)


def test_a_tree_of_merges(spark, monkeypatch):
    monkeypatch.setattr(lsa, "MERGE_FAN_IN", 2)            # 4 partitions: two levels and more
    m = {q: graded(90, 6, 1e-7, q) for q in range(5)}
    got = r_of(triangular_factors(entries(spark, m, 9)))
    for q in m:
        assert np.allclose(got[q].T @ got[q], m[q].T @ m[q], atol=1e-15)


def test_small_components_are_kept(spark):
    """A component a billionth as strong as the first has its factors right."""
    m = graded(200, 4, 1e-9, 7)
    rows = factor_table(triangular_factors(entries(spark, {1: m}))).orderBy("ti").collect()
    _, s, vt = np.linalg.svd(m, full_matrices=False)
    for c in range(4):
        f = np.array([r[f"f{c}"] for r in rows])
        want = vt[c] / s[c]
        assert np.allclose(np.abs(f), np.abs(want), rtol=1e-4 if c == 3 else 1e-8)
    assert all(r.f4 == 0.0 for r in rows)


def test_rows_that_are_not_together_fail():
    import pyarrow as pa
    b = pa.RecordBatch.from_pydict({"query_id": [1, 1], "doc_id": [1, 2], "ti": [0, 0], "w": [1.0, 1.0], "k": [1, 2]})
    with pytest.raises(RuntimeError, match="not grouped"):
        list(lsa._complete([b]))
