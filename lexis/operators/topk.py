"""Top-k per query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexis.functions.scoring import TOP_K, ranking, report
from lexis.operators.query import is_small, maybe_broadcast


def top_k(scores: DataFrame, k: int = TOP_K, group: str = "query_id", score: str = "score",
          tie: str = "doc_id") -> DataFrame:
    """Keep the k best rows per group, add ``rank`` (1..k).

    Ranked on RANK_DIGITS significant digits (so that the order sums were added in
    does not decide), ties to the smaller ``tie`` value; the score that is
    returned is rounded to SCORE_DIGITS decimals. ``row_number() <= k`` lets Spark insert a partial
    WindowGroupLimit before the shuffle: each task keeps only its own k best
    per query, so a query matching most of the corpus still sends at most
    k rows per task to the final sort.
    """
    w = Window.partitionBy(group).orderBy(F.col("_by").desc(), F.col(tie).asc())
    s = scores.withColumn("_by", ranking(F.col(score)))
    best = s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.withColumn(score, report(F.col(score))).drop("_by")


def with_doc_columns(results: DataFrame, docs: DataFrame, cols=("url",)) -> DataFrame:
    """Add document columns (e.g. url, title) to ranked rows.

    Ranked rows are the broadcast side when they measure small, and the
    (corpus-sized) document table is only streamed; larger results (a Boolean
    search has no limit) join by shuffle.
    """
    d = docs.select("doc_id", *cols)
    small = maybe_broadcast(results, is_small(results))
    return d.join(small, "doc_id").select(*results.columns, *cols)
