"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.session import scratch_path

# A side is broadcast only when its counted rows times its row width stay
# under this many bytes; past it the same join runs as a shuffle.
BROADCAST_BYTES = 8 << 20

# The white space of the contracts: space and the ASCII controls \t \n \v \f \r.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    Cuts lineage without tying rows to an executor's disk: a lost executor
    costs a re-read, never a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint when its size is proven small.

    The rows are counted first (callers pass a saved table, so counting reads
    Parquet footers only). Larger sides come back unhinted and the join
    shuffles; the rows are the same either way.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def ascii_lower(col: str | Column) -> Column:
    """A-Z lower-cased, every other character left alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(col: str | Column) -> Column:
    """Number of runs of non-space characters (null: 0), as long.

    Runs end where a word character is followed by white space or the end,
    so the count is a difference of two lengths and no word array is built.
    """
    col = F.col(col) if isinstance(col, str) else col
    flat = F.regexp_replace(col, WORD_CLASS + "+" + SPACE_CLASS + "*", "x")
    flat = F.regexp_replace(flat, "^" + SPACE_CLASS + "+", "")
    return F.coalesce(F.length(flat), F.lit(0)).cast("long")


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20,
                ) -> Iterator[pa.RecordBatch]:
    """The batch cut into pieces of about ``max_bytes`` of text (one row at
    least), so a worker's memory follows the longest text, not the batch."""
    col = batch.column(batch.schema.get_field_index(column))
    if batch.num_rows == 0:
        return
    lens = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lens.astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def whole_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_hash): each row as one struct beside its key, so
    that no column of the input can clash with a column of the operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"))


def matched(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``rows`` joined to ``found`` on (doc_id, text_hash), nulls equal.
    ``found`` has a row for a key at most; its key columns are dropped."""
    keys = {"doc_id": "found_doc_id", "text_hash": "found_text_hash"}
    same = [F.col(k).eqNullSafe(F.col(v)) for k, v in keys.items()]
    return rows.join(found.withColumnsRenamed(keys), same, how).drop(*keys.values())


def replace_text(rows: DataFrame, text: Column, *more: Column) -> DataFrame:
    """The structs' columns with ``text`` replaced, then ``more``."""
    names = rows.schema["row"].dataType.names
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in names], *more)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_uri(path: str) -> str:
    """A Hadoop path as the URI that pyarrow's file systems take."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return "file://" + path if path.startswith("/") else path
