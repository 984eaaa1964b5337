"""A query batch over documents, block by block.

A batch's queries share words, and a document that many queries ask for would
be a row for each (query, word) that it meets. Here the distinct words of the
batch are numbered once, the postings of these words move once, by document,
and tasks turn a run of documents into one dense block of documents x words. Each
query is then a choice of the block's rows: what is shuffled and sorted grows
with the postings, not with the queries that ask for them.

Only for batches that measure small (``query.is_small``): their known words, like
those of a broadcast, are fetched and sent along with the tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.scoring import tf_idf
from lexis.operators.index import Index
from lexis.operators.query import candidate_postings, with_term_stats

# Workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Postings that a task gathers before it makes blocks of them.
BLOCK_ROWS = 1 << 18


@dataclass
class BatchMatrix:
    """``entries`` (doc_id, col, w): a document's postings of batch words, all in
    one partition and next to each other. ``words`` (query_id, ti, term): the known
    words of every query in order; ``columns``: their columns by query."""
    entries: DataFrame
    words: DataFrame
    columns: dict[int, np.ndarray]
    vocabulary: dict[str, int]

    @property
    def width(self) -> int:
        return len(self.vocabulary)


def batch_matrix(index: Index, qterms: DataFrame) -> BatchMatrix:
    """The documents x words matrix of all words of a small batch, tf-idf weights."""
    spark = index.sparkSession
    known = with_term_stats(index, qterms, None, True).select("query_id", "term", "df", "n_docs").collect()
    known.sort(key=lambda r: r.term.encode())            # in Spark's order of strings
    vocabulary: dict[str, int] = {}
    columns: dict[int, list[int]] = {}
    words, stats = [], []
    for r in known:
        if r.term not in vocabulary:
            stats.append((r.term, len(vocabulary), r.df, r.n_docs))
            vocabulary[r.term] = len(vocabulary)
        mine = columns.setdefault(r.query_id, [])
        words.append((r.query_id, len(mine), r.term))
        mine.append(vocabulary[r.term])
    cols = spark.createDataFrame(stats, "term string, col int, df long, n_docs long")
    hits = candidate_postings(index, cols, True, qterms)
    w = tf_idf(F.col("tf"), F.col("n_tokens"), F.col("df"), F.col("n_docs"))
    entries = hits.select("doc_id", "col", w.alias("w")).repartition("doc_id").sortWithinPartitions("doc_id")
    return BatchMatrix(entries, spark.createDataFrame(words, "query_id long, ti int, term string"),
                       {q: np.array(c) for q, c in columns.items()}, vocabulary)


def _starts(doc: pa.Array) -> np.ndarray:
    """Where each document's run of rows begins."""
    a, b = doc[1:], doc[:-1]
    both = pc.and_(a.is_null(), b.is_null())
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), both)
    return np.r_[0, np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1] if len(doc) else np.zeros(0, int)


def blocks(batches: Iterator[pa.RecordBatch], width: int, max_bytes: int):
    """(ids, columns, rows, weights, has, values) of complete documents: ``weights`` is
    words x documents of at most about ``max_bytes``, ``has`` tells which words a
    document holds (a weight may be zero); ``columns`` and ``rows`` are the places
    of all postings, ``values`` their weights."""
    step, held, n = max(1, max_bytes // (8 * max(width, 1))), [], 0

    def dense(part: pa.RecordBatch, starts: np.ndarray):
        ends = np.r_[starts[1:], part.num_rows]
        col, w = (part.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
        for at in range(0, len(starts), step):
            first = starts[at:at + step]
            lo, hi = first[0], ends[min(at + step, len(starts)) - 1]
            row = np.repeat(np.arange(len(first)), np.diff(np.r_[first, hi]))
            weights, has = np.zeros((width, len(first))), np.zeros((width, len(first)), bool)
            weights[col[lo:hi], row], has[col[lo:hi], row] = w[lo:hi], True
            yield part.column(0).take(pa.array(first)), col[lo:hi], row, weights, has, w[lo:hi]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            starts = _starts(part.column(0))
            yield from dense(part.slice(0, starts[-1]), starts[:-1])
            held, n = [part.slice(starts[-1])], part.num_rows - starts[-1]   # its document may go on
    if held:
        part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield from dense(part, _starts(part.column(0)))


def asked(columns: dict, weights: np.ndarray, has: np.ndarray):
    """(query, candidates, documents x words) of every query that has candidates
    in a block: documents with at least one of its words."""
    for q, cols in columns.items():
        rows = np.flatnonzero(has[cols].any(axis=0))
        if len(rows):
            m = weights[cols]
            yield q, rows, (m if len(rows) == m.shape[1] else m[:, rows]).T
