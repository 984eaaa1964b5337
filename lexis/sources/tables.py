"""Table sinks: documents, tokens and postings as parquet, with provenance.

Inserts become bulk writes; the insert-or-ignore of a keyed table becomes an
anti join against what is already stored, so re-running a load (or replaying
a streaming micro-batch) adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def collector(spark: SparkSession, name: str, surname: str, group_name: str | None) -> DataFrame:
    """One provenance row (collector_id, name, surname, group_name); the id is
    md5 of the fields, so the same person always gets the same id."""
    row = spark.createDataFrame([(name, surname, group_name)],
                                "name string, surname string, group_name string")
    cid = F.md5(F.concat_ws("|", "name", "surname", F.coalesce("group_name", F.lit(""))))
    return row.select(cid.alias("collector_id"), "name", "surname", "group_name")


def stamp(docs: DataFrame, collector_row: DataFrame) -> DataFrame:
    """Add the collector's id to every document (a one-row broadcast)."""
    return docs.crossJoin(F.broadcast(collector_row.select("collector_id")))


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_new(spark: SparkSession, df: DataFrame, path: str, key: Sequence[str],
               deal: Sequence[str] | None = None) -> None:
    """Append the rows of ``df`` whose ``key`` is not stored at ``path`` yet
    (insert-or-ignore); duplicates inside ``df`` are folded too. A key with a null
    in it is never found stored.

    New rows and stored keys cross one exchange each and meet in one aggregation.
    ``deal`` names the part of the key that rows are dealt by (all of it by default):
    one whose rows arrive together and are never many, such as a posting's document,
    moves them in long compressible runs.

    The stored files are listed when the plan is built, before the write
    starts, so the rows being added are never seen as stored. A stored table
    that lacks a key column, or cannot be read, is an error.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    # several further columns stay one row's: only a single one needs no struct
    row = F.col(rest[0]) if len(rest) == 1 else F.struct(*rest) if rest else F.lit(True)
    new = df.select(*key, row.alias("_row"), F.lit(False).alias("_old"))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    if stored:
        old = spark.read.parquet(path).select(*key).dropna()
        new = new.unionByName(old.select(*key, F.lit(None).cast(new.schema["_row"].dataType).alias("_row"),
                                         F.lit(True).alias("_old")))
    one = new.repartition(*(deal or key)).groupBy(*key).agg(
        F.first("_row", ignorenulls=True).alias("_row"), F.max("_old").alias("_old")).where(~F.col("_old"))

    def value(c: str):
        return F.col(c) if c in key else F.col("_row" if len(rest) == 1 else f"_row.`{c}`").alias(c)
    one.select(*[value(c) for c in df.columns]).write.mode("append").parquet(path)
