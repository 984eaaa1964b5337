"""Query-side helpers shared by the search operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.index import Index, corpus_stats
from lexis.operators.store import term_part

# Query batches are broadcast to the postings scan when their rows, written
# out, have at most this many bytes -- measured on the frame that is
# broadcast, not assumed.
QUERY_BROADCAST_MAX_BYTES = 64 << 20
# What a row takes in memory beside its values.
ROW_BYTES = 32


def frame_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df`` (a query batch or a result of one, never
    corpus data): the values as JSON text, and a fixed part for each row."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return n * ROW_BYTES + (size or 0)


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether ``df`` may be broadcast."""
    limit = QUERY_BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return frame_bytes(df) <= limit


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast only behind a checked bound; past it the planner picks a
    shuffle join (with AQE's skew handling), so a huge batch still runs."""
    return F.broadcast(df) if small else df


# Copies of the smaller side where a join by word must shuffle: a word with a
# third of all rows is then this many tasks.
SALTS = 32


def hot_join(rows: DataFrame, table: DataFrame, on: str, how: str = "inner",
             small: bool | None = None) -> DataFrame:
    """``rows`` joined to ``table`` on a key whose values may be as frequent
    as stop words. A table that measures small is broadcast; otherwise it is
    copied to every salt, and a row's salt is a hash of the whole row. Same
    rows either way; ``how`` is inner, left, left_semi or left_anti.
    """
    if small is None:
        small = is_small(table)
    if small:
        return rows.join(F.broadcast(table), on, how)
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def with_term_stats(index: Index, qterms: DataFrame, n_docs: int | None = None,
                    small: bool | None = None) -> DataFrame:
    """Known query terms with df and corpus statistics.

    (query_id, term, qtf, first_pos, n_terms, df, n_docs, avg_unique); a query
    word missing from the dictionary contributes nothing (dropped here).
    The query side is the broadcast side; the dictionary is only streamed.
    """
    if small is None:
        small = is_small(qterms)
    known = index.terms.select("term", "df").join(maybe_broadcast(qterms, small), "term")
    return known.crossJoin(corpus_stats(index, n_docs).select("n_docs", "avg_unique"))


def few_terms(qstats: DataFrame, spark) -> list[str] | None:
    """The batch's distinct words when there are few enough to push into the
    parquet scan as equality filters (Spark's IN pushdown threshold), else
    None. Only the distinct words of a counted query batch are fetched."""
    limit = int(spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold", "10"))
    words = qstats.select("term").distinct().limit(limit + 1).collect()
    return [r.term for r in words] if len(words) <= limit else None


def candidate_postings(index: Index, qstats: DataFrame, small: bool = True,
                       qterms: DataFrame | None = None, docs: DataFrame | None = None) -> DataFrame:
    """Postings of the query terms, one row per (query, term, document).

    ``qstats`` has at most one row per (query, term) of the batch (bounded by
    the bytes taken on the parsed batch), so it is the broadcast side and the
    postings are read once, without a shuffle. Of a stored index only the
    parts that the batch's words hash to are read. For a short query the words
    also go into the scan as a filter: postings files are sorted by term, so
    parquet row-group statistics skip most of every file.

    ``docs`` (doc_id, each once) lets only postings of these documents pass,
    before they meet the query words: a set that measures small is broadcast to
    the scan, a larger one is shuffled to the buckets that the postings are
    stored in. Either way the postings stay where they are.
    """
    postings = index.postings
    if small and index.parted is not None and index.term_parts > 1:
        # the numbers of the parts that the batch's words hash to: static
        # partition pruning, whatever the number of words
        part = term_part(F.col("term"), index.term_parts)
        numbers = (qterms if qterms is not None else qstats).select(part.alias("part")).distinct()
        postings = index.parted.where(F.col("part").isin([r.part for r in numbers.collect()])).drop("part")
    if small:
        # The parsed batch (no dictionary join) is enough to list its words.
        words = few_terms(qterms if qterms is not None else qstats, postings.sparkSession)
        if words is not None:
            postings = postings.where(F.col("term").isin(words))
    if docs is not None:
        postings = postings.join(maybe_broadcast(docs, is_small(docs)), "doc_id", "left_semi")
    return hot_join(postings, qstats, "term", small=small)
