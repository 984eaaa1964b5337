"""Whitening against numpy's dense eigendecomposition."""

import math

import numpy as np
import pytest

from conftest import SF001
from lexis.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x int, component int, n long"


def brute(rows, scale=256, components=4):
    """{(vec_id, copy): [...]} from rows (vec_id, vector)."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in ok), default=0)
    if not dim:
        return [], None
    ints = [(i, tuple([math.floor(scale * c) for c in v] + [0] * (dim - len(v)))) for i, v in ok]
    x = np.array(sorted({v for _, v in ints}), dtype=float).reshape(-1, dim)
    n, sums = len(x), [sum(int(c) for c in col) for col in x.T]
    cov = np.cov(x.T, bias=True).reshape(dim, dim)
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:components], vec[:, ::-1][:, :components]
    keep = e > 1e-15 * max(e.max(), 0) if dim else []
    out = []
    for i, v in ints:
        dev = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        for k in range(len(e)):
            if keep[k]:
                w = (np.array(v) - np.array(sums, dtype=float) / n) @ vec[:, k] / math.sqrt(e[k])
                out.append((i, k + 1, n, dev, w, e[k] / np.trace(cov)))
    return out, n


def check(spark, rows, distinct=True):
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)
    w = whitening.fit(df)
    got = whitening.whiten(df, w).collect()
    want, n = brute(rows)
    key = lambda r: (r[0] is None, r[0], r[1], r[3], abs(r[4]))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] < 1e-9
        if distinct:
            assert abs(a[4]) == pytest.approx(abs(b[4]), rel=1e-7, abs=1e-7)
    return got


def test_fixture(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = check(spark, rows)
    assert len(got) == 4 * len(rows)
    assert sorted(registry.QUERIES["op13_whitening"](spark, SF001).columns) == sorted(
        "vec_id component n deviation whitened explained identity_error".split())


def test_decaying_spectrum_stops_early(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 40)) * (0.5 ** np.arange(40)) * 30
    df = spark.createDataFrame([(i, v.tolist(), 0, 1, 2, 3) for i, v in enumerate(x)], SCHEMA)
    assert whitening.fit(df).steps < 40
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)])


def test_nulls_repeats_and_short_vectors(spark):
    nan, inf = float("nan"), float("inf")
    check(spark, [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.3, -0.7, 0.11]),
                  (5, [0.3, -0.7, 0.11]), (6, [0.31]), (7, [-0.0, 0.0, 5.5]), (None, [1.0, 2.0, 3.0]), (8, []),
                  (5, [0.9, 0.2, -1.5]), (9, [0.31, 0.0])])


def test_equal_deviations(spark):
    """A cross of unit steps: all deviations are equal, any basis will do."""
    rows = [(i, [float(s * (j == i)) for j in range(6)]) for i in range(6) for s in (1, -1)]
    assert len(check(spark, rows, distinct=False)) == 4 * 12


def test_low_rank_and_empty(spark):
    assert check(spark, [(i, [i / 16, 2 * i / 16, -i / 16]) for i in range(20)])[-1][1] == 1
    assert check(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])]) == []
    assert check(spark, [(1, None)]) == []
    assert check(spark, [(1, [])]) == []


def test_deviation_past_64_bits(spark):
    rows = [(1, [2.0**40]), (2, [-(2.0**40)]), (3, [0.0])]
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA)
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, whitening.fit(df)).collect()}
    assert got == {1: None, 2: None, 3: 0}
