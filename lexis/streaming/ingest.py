"""Incremental index maintenance with Structured Streaming.

New documents arrive as a stream (files landing in a folder, a table, a
queue); each micro-batch is tokenized and its postings and document rows are
written to the stored index under the batch's epoch, with insert-or-ignore
semantics per document, so a replayed batch (after a failure, from the
checkpoint, or the whole stream again) stores nothing twice. A micro-batch
becomes visible as one new version of the index, its postings, dictionary and
corpus statistics together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexis.operators.index import Index, postings_from_words
from lexis.operators.query import is_small, maybe_broadcast
from lexis.operators.store import (batches_near, commit, load_index, merge_postings, new_generation, read_version,
                                   stored_docs, with_batch, write_batch)
from lexis.operators.tokens import doc_words
from lexis.profile import LanguageProfile


def merged_repeats(dw: DataFrame) -> DataFrame:
    """Postings of one-row-per-document words, those of rows that share a key
    merged into one document. Only such rows move for it: the postings of the
    others come from their own row, as they are."""
    again = dw.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again"))
    if not again.limit(1).collect():
        return postings_from_words(dw)
    again = maybe_broadcast(again, is_small(again))
    shared = F.col("doc_id").eqNullSafe(F.col("_again"))
    return postings_from_words(dw.join(again, shared, "left_anti")).unionByName(
        merge_postings(postings_from_words(dw.join(again, shared, "left_semi"))))


def index_batch(spark: SparkSession, batch: DataFrame, index_path: str, profile: LanguageProfile,
                text_cols: Sequence[str] = ("text",), key: str = "doc_id",
                batch_id: str = "0", repeats: str = "merge") -> None:
    """Add one batch of documents to the stored index (started if there is
    none; ``save_index`` may have written it) as its next version.

    A replayed batch replaces what it stored before and never touches another
    batch's rows. Documents stored by another batch are left out (insert or
    ignore) and counted in the version: only batches whose range of keys meets
    this one's are read, and the keys are broadcast to them when they are few.
    Documents that share a key within the batch become one document with the
    words of all, or fail the batch (``repeats="refuse"``).
    """
    path = index_path.rstrip("/")
    before = read_version(spark, path)
    dw = doc_words(batch, profile, text_cols, key).withColumnRenamed(key, "doc_id").persist()
    try:
        new, ignored = dw, 0
        others = [b for b in before["batches"] if b["batch"] != batch_id] if before else []
        if others:
            keys = dw.select("doc_id").distinct()
            low, high = keys.agg(F.min("doc_id").cast("string"), F.max("doc_id").cast("string")).first()
            near = batches_near(dw, before | {"batches": others}, (low, high))
            if near:
                stored = stored_docs(spark, path, before, near).select("doc_id")
                seen = stored.join(maybe_broadcast(keys, is_small(keys)), "doc_id", "left_semi").distinct()
                new = dw.join(seen, "doc_id", "left_anti")
                ignored = dw.join(seen, "doc_id", "left_semi").count()
        postings = merged_repeats(new) if repeats == "merge" else postings_from_words(new)
        state = before or new_generation(postings)
        # Documents with no token are recorded too, so they are not retried.
        row = write_batch(spark, path, state, postings, new.select("doc_id"), batch_id, all_docs=True)
        commit(spark, path, with_batch(spark, path, state, row | {"ignored": ignored}), before["number"] if before else 0)
    finally:
        dw.unpersist()


def start_ingest(docs_stream: DataFrame, index_path: str, checkpoint: str,
                 profile: LanguageProfile, text_cols: Sequence[str] = ("text",),
                 key: str = "doc_id", available_now: bool = True) -> StreamingQuery:
    """Run ``index_batch`` on every micro-batch of ``docs_stream``.

    ``available_now`` processes what is there and stops (batch-style
    backfill); otherwise the query keeps running on its default trigger.
    """
    spark = docs_stream.sparkSession
    # Epoch ids restart with a new checkpoint: the run id keeps two runs'
    # batches apart; it is stable across restarts of the same checkpoint.
    run = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def each(batch: DataFrame, epoch_id: int) -> None:
        index_batch(spark, batch, index_path, profile, text_cols, key, f"{run}-{epoch_id}")

    w = docs_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def refresh_dictionary(spark: SparkSession, index_path: str) -> Index:
    """The whole index as it stands: batches bring their own part of ``terms``
    and ``corpus``, so there is nothing to compute again."""
    return load_index(spark, index_path)
