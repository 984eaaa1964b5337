"""Bitmap posting lists: same documents as the rows, any whole-number ids."""

from conftest import rows

from lexis.operators.bitmaps import RANGE, bitmap_and, posting_bitmaps
from lexis.operators.boolean import boolean_search
from lexis.operators.index import build_index
from lexis.operators.tokens import parse_queries
from lexis.profile import LATIN

EDGES = [0, 1, -1, 7, 8, RANGE - 1, RANGE, RANGE + 1, -RANGE, -RANGE - 1, 2**40, -(2**40), 2**62]


def test_same_as_rows(spark):
    docs = [(i, "every" + " odd" * (k % 2) + " third" * (k % 3 == 0)) for k, i in enumerate(EDGES)]
    idx = build_index(spark.createDataFrame(docs, "doc_id long, text string"), LATIN)
    texts = ["every", "every odd", "odd third", "every nothing", "", "third every odd"]
    q = parse_queries(spark.createDataFrame(list(enumerate(texts)), "query_id long, text string"), LATIN)
    bitmaps = posting_bitmaps(idx.postings)
    got = rows(bitmap_and(bitmaps, q))
    assert got == rows(boolean_search(idx, q))
    assert sorted(d for k, d in got if k == 0) == sorted(EDGES)
    assert sum(r.n for r in bitmaps.where("term = 'every'").collect()) == len(EDGES)


def test_a_list_of_any_length_is_bounded_by_its_ranges(spark):
    """100,000 documents of one word are four bitmaps."""
    postings = spark.range(100_000).selectExpr("'w' AS term", "id AS doc_id")
    got = posting_bitmaps(postings).collect()
    assert len(got) == 5 and sum(r.n for r in got) == 100_000 and {len(r.bits) for r in got} == {RANGE // 8}
    plan = posting_bitmaps(postings)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan


def test_nulls_and_empty(spark):
    none = spark.createDataFrame([("w", None)], "term string, doc_id long")
    assert posting_bitmaps(none).count() == 0
    q = parse_queries(spark.createDataFrame([(1, "w x")], "query_id long, text string"), LATIN)
    assert bitmap_and(posting_bitmaps(none), q).count() == 0
