"""BM25 ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions.scoring import BM25_B, BM25_K1, TOP_K, bm25_idf, bm25_term
from lexis.operators.index import Index
from lexis.operators.query import candidate_postings, is_small, with_term_stats
from lexis.operators.topk import top_k


def bm25_idf_table(index: Index, qterms: DataFrame, n_docs: int | None = None,
                   small: bool | None = None) -> DataFrame:
    """(query_id, term, qtf, df, idf) with idf = max(0, ln((N-df+.5)/(df+.5)))."""
    q = with_term_stats(index, qterms, n_docs, small)
    return q.select("query_id", "term", "qtf", "first_pos", "df", "n_docs", "avg_unique",
                    bm25_idf(F.col("df"), F.col("n_docs")).alias("idf"))


def bm25_scores(index: Index, qterms: DataFrame, k1: float = BM25_K1, b: float = BM25_B,
                n_docs: int | None = None) -> DataFrame:
    """(query_id, doc_id, score) for every document holding a query term.

    Term weight as in the ranking being matched: tf is the posting's row
    count (1) over the document's distinct-term count, and document length
    is that same distinct-term count, averaged over the corpus. A word
    repeated in the query adds its summand once per repeat (qtf).
    """
    small = is_small(qterms)
    q = bm25_idf_table(index, qterms, n_docs, small).select("query_id", "term", "qtf", "idf",
                                                           "avg_unique")
    hits = candidate_postings(index, q, small, qterms)
    length = F.col("n_unique").cast("double")
    tf = F.lit(1.0) / length
    part = F.col("qtf") * bm25_term(F.col("idf"), tf, length, F.col("avg_unique"), k1, b)
    return hits.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"))


def bm25_search(index: Index, qterms: DataFrame, k: int = TOP_K, k1: float = BM25_K1,
                b: float = BM25_B, n_docs: int | None = None) -> DataFrame:
    """Top-k BM25: (query_id, rank, doc_id, score)."""
    s = bm25_scores(index, qterms, k1, b, n_docs)
    return top_k(s, k).select("query_id", "rank", "doc_id", "score")
