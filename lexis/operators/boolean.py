"""Boolean retrieval: conjunctive (AND) queries over the postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexis.operators.index import Index
from lexis.operators.query import candidate_postings, hot_join, is_small, maybe_broadcast
from lexis.session import scratch_path


def boolean_search(index: Index, qterms: DataFrame) -> DataFrame:
    """Documents holding every word of the query: (query_id, doc_id).

    The list-by-list intersection becomes one aggregation: postings of the
    query words (broadcast join, no shuffle of the postings), counted per
    (query, document) and kept when the count reaches the query's number of
    distinct words. An unknown word can never be counted, so it empties the
    result; a query without usable words has no rows at all.
    """
    small = is_small(qterms)
    q = qterms.select("query_id", "term", "n_terms")
    hits = candidate_postings(index, q, small, qterms)
    matched = hits.groupBy("query_id", "doc_id", "n_terms").agg(F.count(F.lit(1)).alias("m"))
    return matched.where(F.col("m") == F.col("n_terms")).select("query_id", "doc_id")


#: Words, counted from a query's rarest, that the steps of ``rarest_first`` read.
STEPS = ((1, 1), (2, 2), (3, None))


def rarest_first(index: Index, qterms: DataFrame, log: list[int] | None = None) -> DataFrame:
    """The rows of ``boolean_search``, found from each query's rarest word on.

    The rarest word's documents are read first; every later step reads only
    postings of documents that are still possible, so a stop-like word costs as
    many postings as there are possible documents, not its whole list. A query
    with an unknown word is dropped at the dictionary, and the steps end when
    nothing is possible any more. What a step leaves is written down, so a
    lost executor repeats one step. ``log`` gets the rows left by each step.

    Worth its extra passes where lists are long; ``boolean_search`` reads all
    words' lists in one pass.
    """
    small = is_small(qterms)
    order = _written(query_plan(index, qterms), "query-order")
    unknown = order.where("df = 0").select("query_id").distinct()
    order = order.join(maybe_broadcast(unknown, small), "query_id", "left_anti")
    possible = None
    for first, last in STEPS:
        words = order.where(F.col("plan_order") >= first)
        if last is not None:
            words = words.where(F.col("plan_order") <= last)
        words = words.select("query_id", "term", F.count(F.lit(1)).over(Window.partitionBy("query_id")).alias("n"))
        docs = possible.select("doc_id").distinct() if possible is not None else None
        hits = candidate_postings(index, words, small, words, docs)
        if possible is not None:
            hits = hits.join(maybe_broadcast(possible, is_small(possible)), ["query_id", "doc_id"], "left_semi")
        left = (hits.groupBy("query_id", "doc_id", "n").agg(F.count(F.lit(1)).alias("m"))
                    .where(F.col("m") == F.col("n")).select("query_id", "doc_id"))
        if possible is not None:                           # queries that have no more words
            done = possible.join(maybe_broadcast(words.select("query_id").distinct(), small), "query_id", "left_anti")
            left = left.unionByName(done)
        possible = _written(left, "possible")
        n = possible.count()                               # of a written table: its footers
        if log is not None:
            log.append(n)
        if n == 0:
            break
    return possible


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def term_lookup(index: Index, qterms: DataFrame) -> DataFrame:
    """Postings of each query word: (query_id, term, doc_id). One equality
    lookup per word, batched into a single broadcast join."""
    small = is_small(qterms)
    return candidate_postings(index, qterms.select("query_id", "term"), small, qterms).select(
        "query_id", "term", "doc_id")


def intersect_keep_left(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``; left duplicates kept
    (a semi join -- SQL INTERSECT would fold them). Safe against keys that
    hold many of the rows."""
    return hot_join(left, right.select(on).distinct(), on, "left_semi")


def query_plan(index: Index, qterms: DataFrame) -> DataFrame:
    """Query words with their df, rarest first: (query_id, term, df, plan_order).

    An unknown word has df 0 and comes first: it alone decides an empty
    answer. The window runs per query, a group bounded by query length.
    """
    small = is_small(qterms)
    q = qterms.select("query_id", "term")
    # Inner join first (query side broadcast, dictionary streamed), then put
    # the unknown words back with a left join whose build side is small.
    known = index.terms.select("term", "df").join(maybe_broadcast(q, small), "term")
    with_df = q.join(maybe_broadcast(known, small), ["query_id", "term"], "left").withColumn(
        "df", F.coalesce(F.col("df"), F.lit(0)).cast("long"))
    w = Window.partitionBy("query_id").orderBy("df", "term")
    return with_df.withColumn("plan_order", F.row_number().over(w)).select(
        "query_id", "term", "df", "plan_order")


def unknown_terms(index: Index, qterms: DataFrame) -> DataFrame:
    """Query words missing from the dictionary: (query_id, term).

    They contribute nothing to a ranked search and empty a Boolean one; this
    lists them. Both joins keep the query side as the broadcast side: known
    words first (dictionary streamed), then the rest of the batch.
    """
    small = is_small(qterms)
    q = qterms.select("query_id", "term")
    known = index.terms.select("term").join(maybe_broadcast(q, small), "term")
    return q.join(maybe_broadcast(known, small), ["query_id", "term"], "left_anti")
