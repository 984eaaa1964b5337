"""Structured Streaming ingest: micro-batches append to a stored index with
insert-or-ignore, so replaying the whole stream stores nothing twice."""

from conftest import rows

from lexis.operators.index import build_index
from lexis.profile import LATIN
from lexis.session import scratch_path
from lexis.streaming.ingest import refresh_dictionary, start_ingest

DOCS = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry date"), (4, "date apple")]


def test_stream_ingest_replay_is_idempotent(spark):
    base = scratch_path(spark, "t-stream")
    src = f"{base}/incoming"
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    df.where("doc_id <= 2").write.parquet(f"{src}/part1")
    df.where("doc_id > 2").write.parquet(f"{src}/part2")

    def ingest(checkpoint):
        stream = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
                       .option("recursiveFileLookup", "true").parquet(src))
        start_ingest(stream, f"{base}/index", f"{base}/{checkpoint}", LATIN).awaitTermination()

    ingest("ck1")
    ingest("ck1")          # same checkpoint: nothing new to read
    ingest("ck2")          # fresh checkpoint: every batch replayed, nothing stored twice
    df.where("doc_id = 2").write.mode("append").parquet(f"{src}/part3")   # a repeat arrives
    ingest("ck2")
    idx = refresh_dictionary(spark, f"{base}/index")
    lazy = build_index(df, LATIN)
    assert rows(idx.postings, "term", "doc_id", "tf") == rows(lazy.postings, "term", "doc_id", "tf")
    assert rows(idx.terms, "term", "df") == rows(lazy.terms, "term", "df")
    assert idx.corpus.first().n_docs == 4
