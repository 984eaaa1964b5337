"""Latent semantic ranking: a rank-k SVD of each query's candidate matrix.

For one query the matrix has a row per candidate document (a document with
at least one query word) and a column per known query word, holding
tf-idf weights; rows of other terms would be all zero and change no
singular value or vector. With A = U S V^T (documents x words):

* the query folds in as q . V_k . S_k^-1, q = 1 for every known word;
* a document is its row of U_k = (A . V_k . S_k^-1)_d;
* scores compare the two k-vectors (true cosine or the reference form).

Distributed plan: a tall-skinny QR. The postings of a batch's words move once, by
document, whatever the number of queries that ask for them (``batch``); only a
batch too large to be sent to the tasks has a row for each (query, document, word).
Every task reduces its documents' rows of a query's matrix to a triangular factor of at most t x t (t = words in the
query), factors are stacked and reduced again along a tree (``MERGE_FAN_IN``
to one), and the SVD is taken of the one R that is left: A = Q R has A's
singular values and right vectors, to the precision of A itself. (A^T A would
square the condition number; ``gram_matrices`` still gives it.) Documents are
projected by a product of the same blocks with the factor table. Nothing per
document is collected.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexis.functions.scoring import LSA_RANK, TOP_K, cosine, tf_idf
from lexis.operators.batch import BatchMatrix, asked, batch_matrix, blocks
from lexis.operators.index import Index
from lexis.operators.query import candidate_postings, is_small, maybe_broadcast, with_term_stats
from lexis.operators.topk import top_k

# The grouped/Arrow functions below run in Python workers. Pickling this
# module by value ships their code with the task, so workers need no copy of
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Singular values below LSA_RCOND * s_max count as zero: a parameter of this
# implementation, not of the ranking being matched. QR and the SVD of R are
# exact to ~1e-16 * s_max; the cut keeps rounding out of S^-1.
LSA_RCOND = 1e-10

# Triangular factors that meet in one task of the merge tree, about.
MERGE_FAN_IN = 16

# A task holds at most about this many bytes of Gram sums (or triangular
# factors) and of one dense block; past it they are sent on and started afresh.
GRAM_BYTES = 64 << 20
CELLS_PER_BATCH = 1 << 18

GRAM_SCHEMA = "query_id long, i int, j int, g double"
R_SCHEMA = "query_id long, node int, t int, r binary"


def query_matrix(index: Index, qterms: DataFrame, small: bool | None = None) -> DataFrame | BatchMatrix:
    """Each query's documents x words matrix. A small batch: the postings of its
    words, by document. A larger one: entries (query_id, doc_id, ti, term, w) with
    ti = 0..t-1 the word's column."""
    if small is None:
        small = is_small(qterms)
    return batch_matrix(index, qterms) if small else query_entries(index, qterms, small)


def query_entries(index: Index, qterms: DataFrame, small: bool) -> DataFrame:
    """(query_id, doc_id, ti, term, w): a row for each entry of each query's matrix."""
    known = with_term_stats(index, qterms, None, small).select("query_id", "term", "df", "n_docs")
    cols = known.withColumn("ti", (F.row_number().over(
        Window.partitionBy("query_id").orderBy("term")) - 1).cast("int"))
    hits = candidate_postings(index, cols, small, qterms)
    w = tf_idf(F.col("tf"), F.col("n_tokens"), F.col("df"), F.col("n_docs"))
    return hits.select("query_id", "doc_id", "ti", "term", w.alias("w"))


def _dense_blocks(qid: np.ndarray, doc: np.ndarray, ti: np.ndarray, w: np.ndarray):
    """(query, documents x words block) of complete documents whose rows are
    sorted by query and document; a block stays under ``GRAM_BYTES``."""
    if len(qid) == 0:
        return
    qb = np.flatnonzero(np.diff(qid)) + 1
    for lo, hi in zip(np.r_[0, qb], np.r_[qb, len(qid)]):
        row = np.r_[0, np.cumsum(doc[lo + 1:hi] != doc[lo:hi - 1])]   # local document index
        t = int(ti[lo:hi].max()) + 1
        step = max(1, GRAM_BYTES // (8 * t))                         # documents in a block
        for first in range(0, int(row[-1]) + 1, step):
            a, b = np.searchsorted(row, [first, first + step])
            m = np.zeros((min(step, int(row[-1]) + 1 - first), t))
            m[row[a:b] - first, ti[lo + a:lo + b]] = w[lo + a:lo + b]
            yield int(qid[lo]), m


def _widened(m: np.ndarray, t: int) -> np.ndarray:
    return m if m.shape[1] == t else np.pad(m, ((0, 0), (0, t - m.shape[1])))


def _add_gram(acc: dict, q: int, m: np.ndarray) -> None:
    g, old = m.T @ m, acc.get(q)
    if old is not None:
        n = max(len(old), len(g))
        g = np.pad(g, (0, n - len(g))) + np.pad(old, (0, n - len(old)))
    acc[q] = g


def _add_rows(acc: dict, q: int, m: np.ndarray) -> None:
    """Stack rows under the query's triangular factor and reduce them."""
    old = acc.get(q)
    if old is not None:
        t = max(m.shape[1], old.shape[1])
        m = np.vstack([_widened(old, t), _widened(m, t)])
    acc[q] = np.linalg.qr(m, mode="r") if m.shape[0] > 1 else m


def _cells(acc: dict):
    """The sums held so far as rows, a bounded number at a time."""
    for q, g in acc.items():
        i, j = np.nonzero(np.triu(g))
        for at in range(0, len(i), CELLS_PER_BATCH):
            x, y = i[at:at + CELLS_PER_BATCH], j[at:at + CELLS_PER_BATCH]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), q, dtype=np.int64)), pa.array(x.astype(np.int32)),
                 pa.array(y.astype(np.int32)), pa.array(g[x, y])],
                names=["query_id", "i", "j", "g"])


def _complete(batches):
    """Column arrays (query, document, word, weight) of complete documents.

    Rows (query_id, doc_id, ti, w, k) arrive sorted by (query_id, doc_id)
    with k = 1 on each document's first entry, so a document is a contiguous
    run; the run still open at the end of an Arrow batch waits for the next
    one. A run that does not start at k = 1 means the input was not
    co-located, and the task fails rather than return a wrong matrix.
    """
    cols = ("query_id", "doc_id", "ti", "w", "k")
    pend = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0),
            np.empty(0, np.int64)]
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cur = [np.concatenate([p, batch.column(c).to_numpy(zero_copy_only=False)])
               for p, c in zip(pend, cols)]
        qid, doc, k = cur[0], cur[1], cur[4]
        new_run = np.r_[True, (qid[1:] != qid[:-1]) | (doc[1:] != doc[:-1])]
        if not np.array_equal(new_run, k == 1):
            raise RuntimeError("LSA matrix rows are not grouped by (query_id, doc_id)")
        cut = int(np.flatnonzero(new_run)[-1])
        yield tuple(a[:cut] for a in cur[:4])
        pend = [a[cut:] for a in cur]
    if len(pend[0]):
        yield tuple(pend[:4])


def _runs(batches):
    """Blocks of each complete part of a task's entries."""
    for part in _complete(batches):
        yield _dense_blocks(*part)


def _asked(columns: dict):
    """The same of a ``BatchMatrix``, whose queries have ``columns``."""
    width = 1 + max((int(c.max()) for c in columns.values()), default=-1)

    def run(batches):
        for _, _, _, weights, has, _ in blocks(batches, width, GRAM_BYTES):
            yield ((q, m) for q, _, m in asked(columns, weights, has))
    return run


def _reduced(parts, add, send):
    """Per task: ``add`` over this task's blocks, query by query; what is held
    goes out when it passes ``GRAM_BYTES``, and at the end. No Python loop over
    rows: a block is one matrix operation."""
    acc: dict[int, np.ndarray] = {}
    for part in parts:
        for q, m in part:
            add(acc, q, m)
        if sum(g.nbytes for g in acc.values()) > GRAM_BYTES:
            yield from send(acc)                # what comes after the task joins them
            acc.clear()
    yield from send(acc)


def _partial_gram(runs):
    """A_q^T A_q summed over a task's documents, per query."""
    return lambda batches: _reduced(runs(batches), _add_gram, _cells)


def _factor_rows(acc: dict, node: int):
    """Triangular factors as rows, a bounded number of bytes at a time."""
    held, size = [], 0
    for q, r in [*acc.items(), (None, None)]:
        if held and (q is None or size > GRAM_BYTES):
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.int64()), pa.array([node] * len(held), pa.int32()),
                 pa.array([h[1].shape[1] for h in held], pa.int32()),
                 pa.array([h[1].astype("<f8").tobytes() for h in held], pa.binary())],
                names=["query_id", "node", "t", "r"])
            held, size = [], 0
        if q is not None:
            held.append((q, r))
            size += r.nbytes


def _partial_r(runs):
    """Triangular factors of a task's documents, per query."""
    def run(batches):
        node = TaskContext.get().partitionId()
        return _reduced(runs(batches), _add_rows, lambda acc: _factor_rows(acc, node))
    return run


def _merged_r(batches):
    """Factors of the same query and node reduced to one (or to a few, where
    a task would hold too much: the next level merges those)."""
    acc: dict[tuple[int, int], np.ndarray] = {}

    def send():
        for node in sorted({n for _, n in acc}):
            yield from _factor_rows({q: r for (q, n), r in acc.items() if n == node}, node)
        acc.clear()

    for batch in batches:
        for q, node, t, r in zip(*(batch.column(c).to_pylist() for c in range(4))):
            _add_rows(acc, (q, node), np.frombuffer(r, "<f8").reshape(-1, t))
        if sum(g.nbytes for g in acc.values()) > GRAM_BYTES:
            yield from send()
    yield from send()


def _reduced_in_tasks(entries: DataFrame | BatchMatrix, partial, schema: str) -> DataFrame:
    if isinstance(entries, BatchMatrix):
        return entries.entries.mapInArrow(partial(_asked(entries.columns)), schema)
    return _document_runs(entries).mapInArrow(partial(_runs), schema)


def gram_matrices(entries: DataFrame | BatchMatrix) -> DataFrame:
    """(query_id, i, j, g) upper triangle of A^T A for every query.

    Of a ``BatchMatrix`` a document's postings are together. Of entries, the window over (query, document) makes the planner co-locate each
    document's entries and sort them: on a document-partitioned (bucketed)
    index that needs no shuffle at all, otherwise Spark adds one. Its value,
    the number of query words the document holds, is bounded by the query.
    Tasks emit at most t^2 partial sums per query (t = the query's words);
    the final sum is per matrix cell.
    """
    partial = _reduced_in_tasks(entries, _partial_gram, GRAM_SCHEMA)
    return partial.groupBy("query_id", "i", "j").agg(F.sum("g").alias("g"))


def _document_runs(entries: DataFrame) -> DataFrame:
    per_doc = Window.partitionBy("query_id", "doc_id").orderBy("ti")
    return (entries.select("query_id", "doc_id", "ti", "w")
                   .withColumn("k", F.row_number().over(per_doc)))


def triangular_factors(entries: DataFrame | BatchMatrix) -> DataFrame:
    """(query_id, node, t, r): about ``MERGE_FAN_IN`` triangular factors at
    most for every query, whose stacked rows have A's Gram matrix.

    ``r`` holds rows of t doubles. Placed as ``gram_matrices``; a task sends one
    factor of t columns per query, and every level of the tree shuffles those
    to a sixteenth as many (query, node) groups.
    """
    return merge_tree(_reduced_in_tasks(entries, _partial_r, R_SCHEMA))


def merge_tree(r: DataFrame, tasks: int | None = None) -> DataFrame:
    """Triangular factors, ``node`` the number of the task that made each
    (one of ``tasks``), merged until about ``MERGE_FAN_IN`` for each query are
    left."""
    spark = r.sparkSession
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    while tasks > MERGE_FAN_IN:
        tasks = -(-tasks // MERGE_FAN_IN)
        r = (r.withColumn("node", F.floor(F.col("node") / MERGE_FAN_IN).cast("int"))
              .repartition("query_id", "node").mapInArrow(_merged_r, R_SCHEMA))
    return r


def _one_factor(pdf: pd.DataFrame) -> np.ndarray:
    acc: dict[int, np.ndarray] = {}
    for t, r in zip(pdf["t"], pdf["r"]):
        _add_rows(acc, 0, np.frombuffer(r, "<f8").reshape(-1, t))
    return acc[0]


def _gram_of(pdf: pd.DataFrame) -> pd.DataFrame:
    r = _one_factor(pdf)
    i, j = np.triu_indices(r.shape[1])
    return pd.DataFrame({"query_id": np.full(len(i), pdf["query_id"].iloc[0]), "i": i.astype(np.int32),
                         "j": j.astype(np.int32), "g": (r.T @ r)[i, j]})


def gram_of_factors(factors: DataFrame) -> DataFrame:
    """(query_id, i, j, g): R^T R, the upper triangle of A^T A with its zeros."""
    return factors.groupBy("query_id").applyInPandas(_gram_of, GRAM_SCHEMA)


def factor_schema(k: int) -> str:
    return ("query_id long, ti int, " + ", ".join(f"f{c} double" for c in range(k)) + ", "
            + ", ".join(f"q{c} double" for c in range(k)))


def _factors(k: int, rcond: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        qid = int(pdf["query_id"].iloc[0])
        r = _one_factor(pdf)
        t = r.shape[1]
        _, s, right = np.linalg.svd(r, full_matrices=False)
        vec = right.T
        keep = [c for c in range(min(k, len(s))) if s[c] > 0 and s[c] >= rcond * s[0]]
        f = np.zeros((t, k))
        f[:, :len(keep)] = vec[:, keep] / s[keep]
        qv = f.sum(axis=0)              # q = 1 on every known query word
        out = {"query_id": np.full(t, qid, dtype=np.int64), "ti": np.arange(t, dtype=np.int32)}
        out.update({f"f{c}": f[:, c] for c in range(k)})
        out.update({f"q{c}": np.full(t, qv[c]) for c in range(k)})
        return pd.DataFrame(out)
    return run


def factor_table(factors: DataFrame, k: int = LSA_RANK, rcond: float = LSA_RCOND) -> DataFrame:
    """(query_id, ti, f0..f{k-1}, q0..q{k-1}): f_c = V[ti, c] / s_c for the
    k' <= k largest non-zero singular values (zeros past k'), and the folded
    query q . V_k . S_k^-1 repeated on each row. One small group per query: its
    last few triangular factors.

    A word whose weights are all zero (it is in every document) need not have a
    row here: its factors are zero."""
    return factors.groupBy("query_id").applyInPandas(_factors(k, rcond), factor_schema(k))


def _projected(columns: dict, factors: dict[int, np.ndarray], k: int):
    """Tasks of (query_id, doc_id, dot, q2, d2): every candidate's row times its
    query's factors, and the products that the measure takes."""
    width = 1 + max((int(c.max()) for c in columns.values()), default=-1)

    def run(batches):
        for ids, col, row, weights, has, w in blocks(batches, width, GRAM_BYTES):
            if len(w) > np.count_nonzero(has):           # postings that repeat add up
                weights = np.zeros(has.shape)
                np.add.at(weights, (col, row), w)
            for q, rows, m in asked(columns, weights, has):
                f = factors.get(q, np.zeros((m.shape[1], k)))
                d, folded = m @ f, f.sum(axis=0)         # q = 1 on every known query word
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, q, np.int64)), ids.take(pa.array(rows)), pa.array(d @ folded),
                     pa.array(np.full(n, folded @ folded)), pa.array(np.einsum("ij,ij->i", d, d))],
                    names=["query_id", "doc_id", "dot", "q2", "d2"])
    return run


def _batch_scores(a: BatchMatrix, k: int, metric: str, rcond: float) -> DataFrame:
    """Scores of a small batch: its factor table, one row per (query, query word),
    goes to the tasks with the batch."""
    factors: dict[int, np.ndarray] = {q: np.zeros((len(c), k)) for q, c in a.columns.items()}
    for r in factor_table(triangular_factors(a), k, rcond).collect():
        factors[r.query_id][r.ti] = [r[f"f{c}"] for c in range(k)]
    kind = a.entries.schema["doc_id"].dataType.simpleString()
    proj = a.entries.mapInArrow(_projected(a.columns, factors, k),
                                f"query_id long, doc_id {kind}, dot double, q2 double, d2 double")
    return proj.select("query_id", "doc_id", cosine(F.col("dot"), F.col("q2"), F.col("d2"), metric).alias("score"))


def lsa_scores(index: Index, qterms: DataFrame, k: int = LSA_RANK, metric: str = "reference",
               rcond: float = LSA_RCOND) -> DataFrame:
    """(query_id, doc_id, score) for every candidate document.

    A small batch is scored block by block, its postings moved by document only.
    For a larger one the factor table has one column per component (k is fixed when the plan
    is built) and carries the folded query, so projecting a document is one
    aggregation of its entries -- k sums side by side, no k-fold copy of the
    candidates -- and the factor table is consumed once (computing it twice
    would redo the pass over the matrix). It holds one row per (query, query word).
    """
    small = is_small(qterms)
    a = query_matrix(index, qterms, small)
    if isinstance(a, BatchMatrix):
        return _batch_scores(a, k, metric, rcond)
    factors = factor_table(triangular_factors(a), k, rcond)
    comps = list(range(k))
    # left: a document whose words all have zero factors is a candidate still,
    # at the origin, with similarity 0
    zero = F.lit(0.0)
    proj = (a.join(maybe_broadcast(factors, small), ["query_id", "ti"], "left")
             .groupBy("query_id", "doc_id")
             .agg(*[F.coalesce(F.sum(F.col("w") * F.col(f"f{c}")), zero).alias(f"d{c}") for c in comps],
                  *[F.coalesce(F.max(f"q{c}"), zero).alias(f"q{c}") for c in comps]))
    dot = sum((F.col(f"q{c}") * F.col(f"d{c}") for c in comps), F.lit(0.0))
    q2 = sum((F.col(f"q{c}") * F.col(f"q{c}") for c in comps), F.lit(0.0))
    d2 = sum((F.col(f"d{c}") * F.col(f"d{c}") for c in comps), F.lit(0.0))
    return proj.select("query_id", "doc_id", cosine(dot, q2, d2, metric).alias("score"))


def lsa_search(index: Index, qterms: DataFrame, k_results: int = TOP_K, rank: int = LSA_RANK,
               metric: str = "reference", rcond: float = LSA_RCOND) -> DataFrame:
    """Top-k LSA ranking: (query_id, rank, doc_id, score). The default metric
    is the reference form of the measure, as in the ranking being matched."""
    s = lsa_scores(index, qterms, rank, metric, rcond)
    return top_k(s, k_results).select("query_id", "rank", "doc_id", "score")
