"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers (``floor(scale * c)``); each distinct one counts once.
X is their matrix, rows centred on the mean. The bidiagonalisation finds
orthonormal v_1, v_2, ... (one per dimension) and u_1, u_2, ... (one entry per
row of X) with X V = U B, B upper bidiagonal:

    alpha_k u_k     = X v_k - beta_(k-1) u_(k-1)
    beta_k  v_(k+1) = X^T u_k - alpha_k v_k

The SVD of the small B gives the components (V times its right vectors) and
the deviations (its singular values over sqrt(n)).

Each step is one Spark pass over X in blocks of rows, and no u is stored: u_j
is X p_j for a vector p_j as long as a row, so a task forms its entries of all
u_j from its rows. A pass forms r = X v_k less its parts along the earlier u_j,
the inner products of r with them, |r|^2 and X^T r; what the driver adds up
are these few sums, already summed by Spark. The inner products taken from
the rows are subtracted once more (full reorthogonalisation of U; that of V
is done on the driver twice, where V is a few vectors).

The steps stop when nothing of X is left outside V, or when the wanted
components have converged and neither a later singular value nor all of X
outside V could be as large as the last of them. A zero alpha or beta starts
again from another direction, so equal deviations are found as well.

Defined cases: vectors that are null or hold null or non-finite entries have
no row in the result; shorter vectors end in zeros up to the longest one;
fewer than the asked components come back where X has a lower rank (entries of
B under ``RANK_TOL`` of X's size count as zero), none for a single distinct
vector or an empty table; repeated rows each get their rows; other columns are
ignored. A deviation past the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import saved

SCALE = 256
COMPONENTS = 4
#: Rows of a stored block and of a result batch, and bytes of a block at most.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
#: Of X's Frobenius norm: a smaller alpha or beta is zero.
RANK_TOL = 1e-11
#: Of the largest singular value: a component's residual when it has converged.
CONVERGED = 1e-14
SEED = 13


@dataclass
class Whitener:
    """The fit: n distinct vectors of sums ``sums``; component k is
    ``vectors[:, k]``, along which the deviation is ``deviations[k]``."""
    n: int
    sums: np.ndarray
    vectors: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float
    steps: int


def integers(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> Column:
    """The vector as longs floor(scale * c); null where it takes no part."""
    c = F.col(f"`{vector}`").cast("array<double>")
    x = F.transform(c, lambda e: F.floor(e * scale))
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return F.when(~bad, x)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix, short ones ended by zeros."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    lens = np.diff(col.offsets.to_numpy())
    if len(col) and (lens == dim).all():
        return flat.reshape(len(col), dim)
    out = np.zeros((len(col), dim), dtype=np.int64)
    out[np.arange(dim)[None, :] < lens[:, None]] = flat
    return out


def _packed(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Vectors as blocks of little-endian 64-bit integers."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                x = _matrix(batch.column(0).slice(at, rows), dim)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.astype("<i8").tobytes()], pa.binary())], names=["block"])
    return run


def _sums(blocks: DataFrame, dim: int, mean: np.ndarray, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``of`` applied to every block's centred rows, added up by Spark: each
    task sends its own sum, one row per entry, and one row per entry arrives."""
    def run(batches):
        total = None
        for batch in batches:
            for b in batch.column(0):
                x = np.frombuffer(b.as_buffer(), dtype="<i8").reshape(-1, dim) - mean
                part = of(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    got = blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(got))
    for r in got:
        out[r.i] = r.v
    return out


def _away(rng: np.random.Generator, found: np.ndarray) -> np.ndarray:
    """A random unit vector orthogonal to the rows of ``found``."""
    v = rng.standard_normal(found.shape[1])
    for _ in range(3):
        v -= found.T @ (found @ v)
        v /= np.linalg.norm(v)
    return v


def _bidiagonal(blocks: DataFrame, dim: int, mean: np.ndarray, mass: float, wanted: int,
                ) -> tuple[np.ndarray, np.ndarray]:
    """(B, V): ``mass`` is the sum of the squares of all entries of X."""
    rng = np.random.default_rng(SEED)
    small = RANK_TOL * np.sqrt(mass)
    vs, ps, xus = (np.zeros((0, dim)) for _ in range(3))      # rows: v_j, p_j, X^T u_j
    b = np.zeros((0, 0))                                       # U^T X V
    v = _away(rng, vs)
    while True:
        # r = X p is X v without its parts along the u_j, whose products with
        # X v are those of X^T u_j with v
        along = xus @ v
        p = v - ps.T @ along

        def products(x: np.ndarray, p=p, ps=ps) -> np.ndarray:
            r = x @ p
            return np.concatenate([(x @ ps.T).T @ r, x.T @ r, [r @ r]])

        got = _sums(blocks, dim, mean, products)
        again, xr, rr = got[:len(ps)], got[len(ps):-1], got[-1]
        p, xr, along = p - ps.T @ again, xr - xus.T @ again, along + again
        alpha = np.sqrt(max(rr - again @ again, 0.0))
        k = len(vs)
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k], grown[:k, k] = b, along
        vs = np.vstack([vs, v])
        if alpha > small:
            grown[k, k] = alpha
            ps, xus = np.vstack([ps, p / alpha]), np.vstack([xus, xr / alpha])
        else:                                                  # u_k stays zero
            ps, xus = np.vstack([ps, np.zeros(dim)]), np.vstack([xus, np.zeros(dim)])
        b = grown
        w = xus[-1].copy()
        for _ in range(2):
            w -= vs.T @ (vs @ w)
        beta = np.linalg.norm(w)
        left = max(mass - np.sum(b * b), 0.0)
        if len(vs) == dim or left <= small * small:
            return b, vs
        if len(vs) > wanted:
            u, s, _ = np.linalg.svd(b)
            residual = beta * np.abs(u[-1, :wanted])
            if residual.max() <= CONVERGED * s[0] and s[wanted] ** 2 + left < s[wanted - 1] ** 2:
                return b, vs
        v = w / beta if beta > small else _away(rng, vs)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS,
        scale: int = SCALE) -> Whitener:
    """Components of the distinct integer vectors' covariance (divisor n)."""
    x = vectors.select(integers(vectors, vector, scale).alias("x")).where(F.col("x").isNotNull()).distinct()
    x = saved(x, "whitening-fit")
    n, dim, least = x.agg(F.count("*"), F.max(F.size("x")), F.min(F.size("x"))).first()
    if n and least < dim:                                      # vectors that differ in zeros at the end alone
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))
        x = saved(x.select(F.concat("x", zeros).alias("x")).distinct(), "whitening-fit")
        n = x.count()
    none = Whitener(n, np.zeros(dim or 0), np.zeros((dim or 0, 0)), np.zeros(0), np.zeros(0), 0.0, 0)
    if not dim:
        return none
    blocks = saved(x.mapInArrow(_packed(dim), "block binary"), "whitening-blocks")
    sums = np.array([int(r.v) for r in x.select(F.posexplode("x").alias("i", "v")).groupBy("i")
                     .agg(F.sum("v").alias("v")).orderBy("i").collect()], dtype=object)
    mean = (sums / n).astype(float)
    mass = _sums(blocks, dim, mean, lambda a: np.array([np.sum(a * a)]))[0]
    if mass == 0:
        none.sums = sums
        return none
    b, vs = _bidiagonal(blocks, dim, mean, mass, components)
    _, s, right = np.linalg.svd(b)
    keep = [k for k in range(min(components, len(s))) if s[k] > RANK_TOL * np.sqrt(mass)]
    comps = (right[keep] @ vs).T
    comps /= np.linalg.norm(comps, axis=0)
    most = np.abs(comps).argmax(axis=0)
    comps *= np.sign(comps[most, np.arange(len(keep))])        # the largest entry is positive
    deviations = s[keep] / np.sqrt(n)
    k, project = len(keep), comps / deviations

    def moments(a: np.ndarray) -> np.ndarray:
        w = a @ project
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    m = _sums(blocks, dim, mean, moments) / n
    cov = m[k:].reshape(k, k) - np.outer(m[:k], m[:k])
    return Whitener(n, sums, comps, deviations, s[keep] ** 2 / mass,
                    float(np.abs(cov - np.eye(k)).max()), len(vs))


def whiten(vectors: DataFrame, w: Whitener, key: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error):
    a row for each vector that takes part and each component."""
    dim, k, n = len(w.sums), len(w.deviations), w.n
    schema = (f"`{key}` long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias(key), integers(vectors, vector, scale).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    project, mean, sums, explained, error = w.vectors / w.deviations, (w.sums / n).astype(float), w.sums, w.explained, w.identity_error

    def far(x: np.ndarray) -> pa.Array:
        """Sums of (n * x - S)^2, in 64-bit integers where none can overflow."""
        top = max(int(max(abs(int(x.max())), abs(int(x.min())))) * n + abs(int(s)) for s in sums)
        if dim * top * top < 1 << 63:
            d = x * n - sums.astype(np.int64)
            return pa.array((d * d).sum(axis=1))
        exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = _matrix(part.column(1), dim)
                m = len(x)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), far(x).take(pa.array(each)),
                     pa.array(((x - mean) @ project).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
