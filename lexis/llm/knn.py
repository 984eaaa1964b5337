"""Exact top-k search by inner product: a Voronoi kNN join.

Inner products are turned into distances: with M the largest norm, a data
vector x gets one more component sqrt(M^2 - |x|^2) and a query gets 0; then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest vectors are those of highest
score.

1. A bounded sample of data vectors become pivots; every vector belongs to the
   cell of its nearest pivot.
2. Summaries of a cell: for data the k smallest pivot distances, for queries
   their number and largest pivot distance.
3. A query cell's bound: by the triangle inequality no query in it has its
   k-th neighbour farther than (its radius + pivot distance + summary
   distance) of the k best summary entries.
4. A data vector goes to the query cells whose ball of radius + bound reaches
   it, and to no other.
5. Cells are solved locally in blocks of about ``QUERY_BLOCK`` queries and
   ``DATA_BLOCK`` vectors, so a cell that holds most rows is many tasks. How
   many blocks a cell has follows from the vectors that reach it, so queries
   are copied only as often as their own cell has data blocks; a window keeps
   the k best of the blocks' bests.

Bounds are floats and only widen (``SLACK``); scores are integer arithmetic.

Defined cases: vectors that are null or hold a null, NaN or infinite
component, and rows with a null vec_id, take no part; every row is a row of
its own, so rows that repeat a vec_id, with the same vector or another, are
candidates each (of each other too) and, where their id fits, queries each;
shorter vectors are padded with zero components; ties go to the smaller
vec_id; with fewer than k candidates all are returned; no queries or no data
give an empty result; other columns are ignored. Scores past 64 bits wrap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import saved

K = 10
SCALE = 1024
MIN_PIVOTS, MAX_PIVOTS, QUERIES_PER_PIVOT = 8, 256, 64
QUERY_BLOCK, DATA_BLOCK = 512, 16_384
SLACK = 1e-6
SEED = 2


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, row): floor(scale * x) of every usable vector, rows numbered
    (the numbers are fixed only once the result is written)."""
    x = F.col("embedding")
    fit = F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & fit)
                   .select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"),
                           F.monotonically_increasing_id().alias("row")))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix, zero-padded to ``dim``."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _lists(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors with their extra component to all pivots."""
    full = np.hstack([x.astype(np.float64), extra[:, None]])
    sq = (full * full).sum(1)[:, None] - 2 * full @ pivots.T + (pivots * pivots).sum(1)[None]
    return np.sqrt(np.maximum(sq, 0))


def _extra(x: np.ndarray, max_sq: float) -> np.ndarray:
    f = x.astype(np.float64)
    return np.sqrt(np.maximum(max_sq - (f * f).sum(1), 0))


def _assign(pivots: np.ndarray, max_sq: float, query: bool):
    dim = pivots.shape[1] - 1

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            d = _distances(x, np.zeros(len(x)) if query else _extra(x, max_sq), pivots)
            cell = d.argmin(1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), batch.column("row"),
                 pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell])],
                ["vec_id", "v", "row", "cell", "dist"])
    return run


def _reached(batch: pa.RecordBatch, pivots: np.ndarray, max_sq: float,
             reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for every cell whose ball (negative: none) a vector is in."""
    x = _matrix(batch.column("v"), pivots.shape[1] - 1)
    return np.nonzero(_distances(x, _extra(x, max_sq), pivots) <= reach)


def _reach_counts(pivots: np.ndarray, max_sq: float, reach: np.ndarray):
    """How many vectors of a task reach each cell."""
    def run(batches):
        n = np.zeros(len(pivots), np.int64)
        for batch in batches:
            n += np.bincount(_reached(batch, pivots, max_sq, reach)[1], minlength=len(pivots))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n)],
                                         ["cell", "n"])
    return run


def _copies(pivots: np.ndarray, max_sq: float, reach: np.ndarray, blocks: np.ndarray):
    """Copies of each data vector for the query blocks of every cell whose
    ball reaches it."""
    def run(batches):
        for batch in batches:
            row, cell = _reached(batch, pivots, max_sq, reach)
            times = blocks[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            for at in range(0, max(len(row), 1), 1 << 16):
                pick = slice(at, at + (1 << 16))
                taken = pa.array(row[pick])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(taken) for c in ("vec_id", "v", "row")),
                     pa.array(cell[pick].astype(np.int32)), pa.array(block[pick].astype(np.int32))],
                    ["vec_id", "v", "row", "cell", "qb"])
    return run


def best(queries: np.ndarray, q_rows: np.ndarray, data: np.ndarray, ids: np.ndarray,
         rows: np.ndarray, k: int):
    """(number of the query, vec_id, score) of each query's k best in one block."""
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(
        queries.shape[1], 1) < 2 ** 53
    order = np.argsort(ids, kind="stable")             # ties to the smaller id
    data, ids, rows = data[order], ids[order], rows[order]
    right = data.T.astype(np.float64) if exact else data.T
    out_q, out_id, out_s = [], [], []
    for at in range(0, len(queries), 64):
        part = queries[at:at + 64]
        scores = ((part.astype(np.float64) @ right).astype(np.int64) if exact else part @ right)
        for i, s in enumerate(scores, at):
            other = rows != q_rows[i]
            s, who = s[other], ids[other]
            if len(s) > k:
                some = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                s, who = s[some], who[some]
            top = np.argsort(-s, kind="stable")[:k]
            out_q.append(np.full(len(top), i))
            out_id.append(who[top])
            out_s.append(s[top])
    join = lambda xs: np.concatenate(xs) if xs else np.empty(0, np.int64)
    return join(out_q), join(out_id), join(out_s)


def _solve(dim: int, k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids, q_rows = left.column("vec_id").to_numpy(), left.column("row").to_numpy()
        q, i, s = best(_matrix(_lists(left.column("v")), dim), q_rows,
                       _matrix(_lists(right.column("v")), dim), right.column("vec_id").to_numpy(),
                       right.column("row").to_numpy(), k)
        return pa.table({"query_row": pa.array(q_rows[q], pa.int64()),
                         "query_id": pa.array(q_ids[q], pa.int64()),
                         "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})
    return run


def bounds(pivots: np.ndarray, radius: np.ndarray, summaries: list[tuple[int, float]],
           k: int) -> np.ndarray:
    """For each query cell an upper limit of any of its queries' distance to
    the k-th neighbour other than itself (infinite if data are too few)."""
    full = np.full(len(pivots), np.inf)
    if len(summaries) > k:
        cell = np.array([c for c, _ in summaries])
        far = np.array([d for _, d in summaries])
        between = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(2), 0))
        reach = radius[:, None] + between[:, cell] + far[None]
        full = np.partition(reach, k, axis=1)[:, k]    # one entry may be the query itself
    return full


def knn_join(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE,
             pivots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vector that fits
    ``is_query`` (on vec_id) the k others of highest integer inner product."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    data = saved(quantized(vectors, scale), "knn-vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    n, n_queries, dim, max_sq = data.agg(
        F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.max(F.size("v")), F.max(square)).first()
    if not n or not n_queries:
        return empty
    p = pivots or int(np.clip(-(-n_queries // QUERIES_PER_PIVOT), MIN_PIVOTS, MAX_PIVOTS))
    sample = data.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id", "v").limit(p).select("v").collect()
    px = _matrix(pa.array([r["v"] for r in sample], pa.list_(pa.int64())), dim)
    px = np.hstack([px.astype(np.float64), _extra(px, max_sq)[:, None]])
    schema = "vec_id long, v array<bigint>, row long, cell int, dist double"
    cells = data.mapInArrow(_assign(px, max_sq, False), schema)
    queries = saved(data.where(is_query).mapInArrow(_assign(px, max_sq, True), schema), "knn-queries")

    # summaries: k + 1 rows a cell at most, and one row a query cell
    near = Window.partitionBy("cell").orderBy("dist", "vec_id")
    entries = (cells.select("cell", "dist", "vec_id").withColumn("r", F.row_number().over(near))
                    .where(F.col("r") <= k + 1).select("cell", "dist").collect())
    radius, count = np.zeros(len(px)), np.zeros(len(px), np.int64)
    for c, r, m in queries.groupBy("cell").agg(F.max("dist"), F.count(F.lit(1))).collect():
        radius[c], count[c] = r, m
    limit = bounds(px, radius, [(e["cell"], e["dist"]) for e in entries], k)
    reach = np.where(count > 0, (radius + limit) * (1 + SLACK) + SLACK, -1.0)

    # blocks of each cell: of its queries, and of the vectors that reach it
    reaching = np.zeros(len(px), np.int64)
    for c, m in (data.mapInArrow(_reach_counts(px, max_sq, reach), "cell int, n long")
                     .groupBy("cell").agg(F.sum("n")).collect()):
        reaching[c] = m
    q_blocks, d_blocks = -(-count // QUERY_BLOCK), -(-reaching // DATA_BLOCK)
    of_cell = lambda blocks: F.element_at(                           # noqa: E731
        F.array(*[F.lit(int(max(b, 1))) for b in blocks]), F.col("cell") + 1)
    keys = ["cell", "qb", "db"]
    right = (data.mapInArrow(_copies(px, max_sq, reach, q_blocks),
                             "vec_id long, v array<bigint>, row long, cell int, qb int")
                 .withColumn("db", F.pmod(F.xxhash64("row"), of_cell(d_blocks)).cast("int")))
    # a query's block: hashed, so that no window gathers a cell
    left = (queries.withColumn("qb", F.pmod(F.xxhash64(F.lit(SEED), "row"), of_cell(q_blocks)).cast("int"))
                   .withColumn("db", F.explode(F.sequence(F.lit(0), of_cell(d_blocks) - 1)))
                   .select("vec_id", "v", "row", *keys))
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
                 .applyInArrow(_solve(dim, k), "query_row long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
