"""Boolean AND from the rarest word on: same rows, fewer postings."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lexis.operators import query
from lexis.operators.boolean import boolean_search, rarest_first
from lexis.operators.index import build_index
from lexis.operators.query import candidate_postings
from lexis.operators.store import save_index
from lexis.operators.tokens import parse_queries
from lexis.profile import LATIN
from lexis.session import scratch_path

@pytest.fixture(scope="module")
def index(spark):
    docs = [(i, " ".join(["every"] + ["half"] * (i % 2 == 0) + ["tenth"] * (i % 10 == 0) + ["two"] * (i in (20, 31))))
            for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return save_index(build_index(frame, LATIN), scratch_path(spark, "rarest"), term_parts=3)


def batch(spark, *texts):
    return parse_queries(spark.createDataFrame(list(enumerate(texts)), "query_id long, text string"), LATIN)


QUERIES = ["every half tenth two", "every two", "half", "every half", "two nothing", "", "every tenth half", "12"]


@pytest.mark.parametrize("limit", [query.QUERY_BROADCAST_MAX_BYTES, 0])
def test_same_rows_as_one_pass(spark, index, monkeypatch, limit):
    monkeypatch.setattr(query, "QUERY_BROADCAST_MAX_BYTES", limit)
    qs = batch(spark, *QUERIES)
    got = rows(rarest_first(index, qs))
    assert got == rows(boolean_search(index, qs))
    assert [r for r in got if r[0] == 0] == [(0, 20)]


def test_steps_end_when_nothing_is_possible(spark, index):
    log = []
    assert rows(rarest_first(index, batch(spark, "every nothing", "half unknown"), log)) == []
    assert log == [0]
    log = []
    assert rows(rarest_first(index, batch(spark, "two tenth half every"), log)) == [(0, 20)]
    assert log == [2, 1, 1]


def test_common_lists_are_filtered_at_the_scan(spark, index):
    qs = batch(spark, "every half")
    docs = spark.createDataFrame([(20,), (31,)], "doc_id long")
    words = qs.select("query_id", "term")
    assert candidate_postings(index, words, True, words).count() == 60
    few = candidate_postings(index, words, True, words, docs)
    assert rows(few, "term", "doc_id") == [("every", 20), ("every", 31), ("half", 20)]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan and "Exchange hashpartitioning(doc_id" not in plan


def test_a_large_set_goes_to_the_buckets(spark, index, monkeypatch):
    """Postings stay in their buckets; only the possible documents move."""
    monkeypatch.setattr(query, "QUERY_BROADCAST_MAX_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = batch(spark, "every half").select("query_id", "term")
        docs = spark.range(0, 40, 3).select(F.col("id").alias("doc_id"))
        few = candidate_postings(index, words, True, words, docs)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(doc_id") <= 1
        assert few.count() == 14 + 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
