"""The stored index: reopened elsewhere, appended to, ingested into."""

import subprocess
import sys

import pytest
from conftest import ROOT, rows

from lexis.operators.index import build_index, merge_repeated, weighted_postings
from lexis.operators.store import load_index, postings_table_name, save_index
from lexis.profile import LATIN
from lexis.session import scratch_path
from lexis.sources.tables import append_new
from lexis.streaming.ingest import refresh_dictionary, start_ingest

DOCS = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry date"), (4, "date apple"), (5, "12 !")]
SCHEMA = "doc_id long, text string"


def frame(spark, docs):
    return spark.createDataFrame(docs, SCHEMA)


def same(index, docs, spark):
    lazy = build_index(frame(spark, docs), LATIN)
    cols = lazy.postings.columns
    assert rows(index.postings, *cols) == rows(lazy.postings, *cols)
    assert rows(index.terms, "term", "df") == rows(lazy.terms, "term", "df")
    assert rows(index.docs, "doc_id", "n_tokens") == rows(lazy.docs.where("n_tokens > 0"), "doc_id", "n_tokens")
    assert [tuple(r) for r in index.corpus.collect()] == [tuple(r) for r in lazy.corpus.collect()]


def test_reopen_without_the_catalog(spark):
    path = scratch_path(spark, "it's an index")
    save_index(build_index(frame(spark, DOCS), LATIN), path)
    spark.sql(f"DROP TABLE {postings_table_name(path)}")
    same(load_index(spark, path), DOCS, spark)


def test_reopen_in_another_process(spark):
    path = scratch_path(spark, "other-process")
    save_index(build_index(frame(spark, DOCS), LATIN), path)
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from lexis.session import get_spark
from lexis.operators.store import load_index
spark = get_spark("local[1]")
print("FOUND", load_index(spark, {path!r}).postings.count())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         cwd=scratch_path(spark, "x").rsplit("/", 1)[0].replace("file:", "") or "/tmp")
    assert "FOUND 8" in out.stdout, out.stderr[-2000:]


def test_append_equals_one_build(spark):
    path = scratch_path(spark, "append")
    save_index(build_index(frame(spark, DOCS[:2]), LATIN), path)
    i = save_index(build_index(frame(spark, DOCS[2:]), LATIN), path, mode="append")
    same(i, DOCS, spark)
    assert weighted_postings(i).count() == 8
    with pytest.raises(ValueError):
        save_index(build_index(frame(spark, DOCS[:1]), LATIN), path, mode="append")
    same(load_index(spark, path), DOCS, spark)
    with pytest.raises(ValueError):
        save_index(i, path, mode="ignore")


def test_repeated_keys_are_refused_or_merged(spark):
    docs = frame(spark, [(1, "a b"), (1, "a b"), (2, "c")])
    with pytest.raises(ValueError):
        save_index(build_index(docs, LATIN), scratch_path(spark, "repeated"))
    merged = build_index(merge_repeated(docs), LATIN)
    assert rows(merged.postings, "doc_id", "term", "tf") == [(1, "a", 2), (1, "b", 2), (2, "c", 1)]


def test_ingest_into_a_saved_index(spark):
    base = scratch_path(spark, "ingest")
    save_index(build_index(frame(spark, DOCS[:2]), LATIN), f"{base}/index")
    for k, d in enumerate(DOCS[1:]):                   # document 2 arrives again
        frame(spark, [d]).coalesce(1).write.parquet(f"{base}/in/{k}")
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                   .option("recursiveFileLookup", "true").parquet(f"{base}/in"))
    q = start_ingest(stream, f"{base}/index", f"{base}/checkpoint", LATIN)
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 3
    same(refresh_dictionary(spark, f"{base}/index"), DOCS, spark)


def test_append_new_lets_errors_through(spark):
    path = scratch_path(spark, "keyless")
    spark.range(3).withColumnRenamed("id", "other").write.parquet(path)
    with pytest.raises(Exception, match="doc_id"):
        append_new(spark, frame(spark, DOCS), path, ["doc_id"])


def test_building_a_plan_starts_no_job(spark):
    shuffled = frame(spark, DOCS).repartition(3, "doc_id").groupBy("doc_id").agg({"text": "max"})
    shuffled = shuffled.withColumnRenamed("max(text)", "text")
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "none")
    build_index(shuffled, LATIN)
    assert not sc.statusTracker().getJobIdsForGroup("plan-only")
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_search_reads_only_the_parts_of_its_words(spark):
    from lexis.operators.bm25 import bm25_search
    from lexis.operators.tokens import parse_queries
    path = scratch_path(spark, "parts")
    docs = frame(spark, [(i, " ".join(f"w{chr(97 + (i * k) % 26)}x" for k in range(1, 9))) for i in range(60)])
    index = build_index(docs, LATIN)
    stored = save_index(index, path, term_parts=64)
    queries = frame(spark, [(1, "wax wbx"), (2, "wcx nothing")]).withColumnRenamed("doc_id", "query_id")
    q = parse_queries(queries, LATIN)
    got = bm25_search(stored, q)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part#" in plan
    everything = {f.rsplit("/part=", 1)[1].split("/")[0] for f in stored.parted.inputFiles()}
    words = q.select("term").distinct().count()
    assert len(everything) > words
    read = {r.part for r in stored.parted.where("term in ('wax', 'wbx', 'wcx')").select("part").distinct().collect()}
    assert len(read) <= 3
    assert rows(got) == rows(bm25_search(index, q))
