"""Reading the input tables and shaping them into documents and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Bytes a core has to read before a scan counts as wide enough.
SPREAD_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Give a scan at least the cluster's parallelism.

    Text tables often arrive as few large row groups, so the scan has fewer
    tasks than cores and the per-row tokenizing would run on one core. Only
    then are rows redistributed -- hashed on ``key`` when given (deterministic
    on retry without the sort a round-robin exchange needs).

    The width is judged from the sizes of the files that are read, so nothing
    runs while a plan is built. Frames that read no files, or enough bytes to
    fill the cores (the 100 TB case), are left as they are.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if _is_plain_scan(df) and _scan_bytes(df) < want * SPREAD_BYTES:
        return df.repartition(want, key) if key else df.repartition(want)
    return df


def _is_plain_scan(df: DataFrame) -> bool:
    """Whether the plan only reads and projects: anything with a shuffle,
    a join or a sort in it has the partitions its author chose."""
    plan = df._jdf.queryExecution().analyzed().toString()
    names = {line.strip(" :+-").split("(")[0].split(" ")[0] for line in plan.splitlines() if line.strip()}
    return names <= {"Project", "Filter", "Relation", "SubqueryAlias", "View"} and "Relation" in plan


def _scan_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as (doc_id, text)."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per conversation turn: (doc_id, conv_id, turn, role, text).

    doc_id = conv_id * 2**32 + turn, so turn documents keep a single bigint
    key. Ids that would not fit (a negative or 32-bit turn, a conv_id past
    31 bits) fail the query rather than share a key.
    """
    c = table(spark, sf_dir, "conversations")
    fits = F.col("turn").between(0, 2**32 - 1) & F.col("conv_id").between(-2**31, 2**31 - 1)
    doc_id = F.when(fits, F.col("conv_id") * F.lit(2**32) + F.col("turn")).when(
        fits.isNotNull(), F.raise_error(F.lit("conversation or turn id out of range")).cast("long"))
    return c.select(doc_id.alias("doc_id"),
                    "conv_id", "turn", "role", "text")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``benchmark`` passages as a query batch (query_id, text)."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
