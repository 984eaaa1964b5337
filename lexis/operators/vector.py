"""Vector-space ranking over tf-idf weights."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.scoring import TOP_K, cosine, report, tf_idf, vector_idf
from lexis.operators.batch import BatchMatrix, batch_matrix, blocks
from lexis.operators.index import Index, corpus_stats
from lexis.operators.query import candidate_postings, is_small, maybe_broadcast, with_term_stats
from lexis.operators.topk import top_k

# Workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of one block of weights, and of the vectors sent on at a time.
VECTOR_BYTES = 32 << 20


def vector_idf_table(index: Index, qterms: DataFrame, n_docs: int | None = None,
                     small: bool | None = None) -> DataFrame:
    """(query_id, term, qtf, first_pos, df, idf) with idf = ln(N / df).

    ``n_docs`` fixes the query-side N (the ranking being matched used 30);
    document weights always use the index's own N.
    """
    q = with_term_stats(index, qterms, n_docs, small)
    return q.select("query_id", "term", "qtf", "first_pos", "df",
                    vector_idf(F.col("df"), F.col("n_docs")).alias("idf"))


def query_weighted_postings(index: Index, qterms: DataFrame, n_docs: int | None = None,
                            small: bool | None = None) -> DataFrame:
    """Postings of the query terms with their tf-idf weight ``w`` and the
    query-side ``idf``: (query_id, term, doc_id, qtf, idf, w).

    The weight is computed on the fly from tf, the document length carried
    on the posting and the df looked up for the (few) query terms: no join
    of the whole postings table with the dictionary.
    """
    if small is None:
        small = is_small(qterms)
    q = vector_idf_table(index, qterms, n_docs, small)
    n_index = corpus_stats(index).select(F.col("n_docs").alias("n_index"))
    q = q.crossJoin(n_index)
    hits = candidate_postings(index, q.select("query_id", "term", "qtf", "idf", "df", "n_index"),
                              small, qterms)
    w = tf_idf(F.col("tf"), F.col("n_tokens"), F.col("df"), F.col("n_index"))
    return hits.select("query_id", "term", "doc_id", "qtf", "idf", w.alias("w"))


def cosine_scores(index: Index, qterms: DataFrame, metric: str = "cosine",
                  n_docs: int | None = None) -> DataFrame:
    """(query_id, doc_id, score) for documents with at least one query term.

    Both vectors span the query's words only; a word repeated in the query
    is a repeated dimension, so qtf multiplies the dot product and both
    squared norms. |q| comes from all known words of the query, not only
    the ones a document matched.
    """
    small = is_small(qterms)
    hits = query_weighted_postings(index, qterms, n_docs, small)
    qi = vector_idf_table(index, qterms, n_docs, small)
    qnorm = qi.groupBy("query_id").agg(F.sum(F.col("qtf") * F.col("idf") * F.col("idf")).alias("q2"))
    agg = hits.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qtf") * F.col("idf") * F.col("w")).alias("dot"),
        F.sum(F.col("qtf") * F.col("w") * F.col("w")).alias("d2"))
    scored = agg.join(maybe_broadcast(qnorm, small), "query_id")
    return scored.select("query_id", "doc_id",
                         cosine(F.col("dot"), F.col("q2"), F.col("d2"), metric).alias("score"))


def cosine_search(index: Index, qterms: DataFrame, k: int = TOP_K, metric: str = "cosine",
                  n_docs: int | None = None) -> DataFrame:
    """Top-k vector-space ranking: (query_id, rank, doc_id, score).

    ``metric="reference"`` keeps the dot / |q| * |d| form being matched.
    """
    return top_k(cosine_scores(index, qterms, metric, n_docs), k).select(
        "query_id", "rank", "doc_id", "score")


def dense_vectors(index: Index, qwords: DataFrame, qterms: DataFrame,
                  n_docs: int | None = None) -> DataFrame:
    """Zero-filled document vectors over each query's word list.

    ``qwords``: (query_id, words array) in query order with repeats.
    Returns (query_id, doc_id, vector array<double>) for every candidate
    document. A small batch: the postings of its words move once, by document,
    and tasks read the vectors of a run of documents off one block of weights,
    query by query (``batch``). A larger batch: each candidate's weights become a
    small map (bounded by the query's distinct words) and the vector is read off
    the word list. Either way the doc x word grid is never shuffled.
    """
    small = is_small(qterms)
    if small and is_small(qwords):
        return _batch_vectors(batch_matrix(index, qterms), qwords)
    hits = query_weighted_postings(index, qterms, n_docs, small)
    maps = hits.groupBy("query_id", "doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("m"))
    joined = maps.join(maybe_broadcast(qwords, is_small(qwords)), "query_id")
    vec = F.transform("words", lambda t: report(F.coalesce(F.try_element_at("m", t), F.lit(0.0))))
    return joined.select("query_id", "doc_id", vec.alias("vector"))


def _batch_vectors(a: BatchMatrix, qwords: DataFrame) -> DataFrame:
    """Vectors of a small batch. Weights are rounded once for each posting; words
    that no document holds read a row of zeros. A (document, word) that comes
    twice is an error, as the weight to read would be either."""
    # by row of ``qwords`` (an id that repeats has a vector for each)
    lists = [(r.query_id, a.columns[r.query_id], np.array([a.vocabulary.get(t, a.width) for t in r.words], int))
             for r in qwords.collect() if r.query_id in a.columns]
    width = a.width

    def run(batches):
        for ids, _, _, weights, has, w in blocks(batches, width, VECTOR_BYTES):
            if len(w) > np.count_nonzero(has):
                raise ValueError("a document has two postings of one word: merge or drop repeated keys first")
            weights = np.vstack([weights, np.zeros((1, weights.shape[1]))])
            for q, cols, places in lists:
                rows = np.flatnonzero(has[cols].any(axis=0))
                step = max(1, VECTOR_BYTES // (8 * len(places)))
                for at in range(0, len(rows), step):
                    some = rows[at:at + step]
                    flat = np.ascontiguousarray(weights[places][:, some].T).ravel()
                    ends = np.arange(0, len(flat) + 1, len(places), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), q, np.int64)), ids.take(pa.array(some)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                        names=["query_id", "doc_id", "vector"])
    kind = a.entries.schema["doc_id"].dataType.simpleString()
    rounded = a.entries.withColumn("w", report(F.col("w")))
    return rounded.mapInArrow(run, f"query_id long, doc_id {kind}, vector array<double>")
