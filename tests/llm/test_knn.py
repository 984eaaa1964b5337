"""The kNN join against all pairs."""

import math
import random

import numpy as np
import pytest
from conftest import SF01
from llm.helpers import as_set
from pyspark.sql import functions as F

from lexis.llm import knn as K

NAN, INF = float("nan"), float("inf")


def brute(rows, k=10, every=100):
    fit = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(fit):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(fit) if m != n)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def run(df, **options):
    return as_set(K.knn_join(df, F.col("vec_id") % 100 == 0, **options), "query_id", "rank", "vec_id", "score")


def vectors(n, dim=6, seed=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 3) for _ in range(dim)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.2) for c in centres[i % 5]]) for i in range(n)]


@pytest.mark.parametrize("pivots", [1, 7, 40])
def test_clustered_vectors(spark, monkeypatch, pivots):
    monkeypatch.setattr(K, "QUERY_BLOCK", 3)
    monkeypatch.setattr(K, "DATA_BLOCK", 200)
    rows = vectors(900) + [(1000 + i, [1.0] * 6) for i in range(120)]       # a hot vector, ties
    assert run(frame(spark, rows), pivots=pivots) == brute(rows)


def test_pruning_leaves_vectors_out(spark):
    rows = vectors(900)
    px = np.array([v for _, v in rows[:5]])
    bound = K.bounds(px, np.full(5, 1.0), [(i % 5, 0.5) for i in range(100)], 10)
    assert np.isfinite(bound).all() and bound.max() < np.abs(px[0] - px[1]).max() * 3


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.5, -1.0]), (1, None), (2, [1.0, None]), (3, [NAN, 1.0]), (4, [INF, 0.0]),
            (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [1.0]), (7, []), (None, [1.0, 1.0]), (200, [0.0, 0.0]),
            (8, [1.0, 2.0]), (-100, [3.0, 1.0])]
    assert run(frame(spark, rows)) == brute(rows)


def test_rows_that_repeat_an_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (2, [0.7, 0.0]), (2, [0.7, 0.0]),
            (100, [0.2, 1.0]), (100, [0.3, -1.0]), (100, [0.3, -1.0])] + vectors(60, 2)
    df = frame(spark, rows)
    for k in (1, 3, 10):
        assert run(df, k=k) == brute(rows, k)
    assert [r[2] for r in run(frame(spark, rows[:5])) if r[0] == 0] == [1, 2, 2, 1]


def test_queries_are_copied_only_where_data_reach(spark, monkeypatch, tmp_path):
    """Two far groups: a cell's queries meet the blocks of their own group."""
    monkeypatch.setattr(K, "QUERY_BLOCK", 4)
    monkeypatch.setattr(K, "DATA_BLOCK", 100)
    rng = random.Random(1)
    rows = [(i, [s * 50 + rng.gauss(0, 0.1), s * 50 + rng.gauss(0, 0.1)])
            for i in range(2000) for s in [1 if i % 200 < 100 else -1]]
    solve, log = K._solve, str(tmp_path)

    def counted(dim, k):
        inner = solve(dim, k)

        def run(key, left, right):
            with open(f"{log}/{'-'.join(str(x.as_py()) for x in key)}", "w") as f:
                f.write(f"{left.num_rows} {right.num_rows}")
            return inner(key, left, right)
        return run

    monkeypatch.setattr(K, "_solve", counted)
    assert run(frame(spark, rows), pivots=8) == brute(rows)
    copied = [tuple(map(int, f.read_text().split())) for f in tmp_path.iterdir()]
    n_queries, n_blocks = 20, 2000 // 100
    assert sum(q for q, _ in copied) < n_queries * n_blocks


def test_no_queries_no_rows_one_row(spark):
    assert run(frame(spark, [(1, [1.0])])) == []
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(100, [1.0])])) == []


def test_large_components(spark):
    rows = [(i, [(-1) ** i * 2.0**18 * (i + 1), 3.0]) for i in range(30)]
    assert run(frame(spark, rows)) == brute(rows)


def test_fixture(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert run(df.withColumn("dist", F.lit(1)).withColumn("cell", F.lit("x"))) == brute(rows)
