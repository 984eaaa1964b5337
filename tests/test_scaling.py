"""Steps whose cost may grow no faster than the input: the same rows, by plans
without what grew."""

import hashlib

from conftest import rows

from lexis.operators.bitmaps import posting_bitmaps
from lexis.operators.index import build_index, materialize, postings_from_words
from lexis.operators.latent import entries, probe
from lexis.operators.store import merge_postings
from lexis.operators.tokens import doc_words
from lexis.profile import LATIN
from lexis.session import scratch_path
from lexis.sources.tables import append_new
from lexis.streaming.ingest import merged_repeats


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_bitmap_crosses_an_exchange(spark):
    postings = spark.range(100).selectExpr("concat('w', id % 7) AS term", "id AS doc_id")
    plan = plan_of(posting_bitmaps(postings))
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange hashpartitioning(term")
    assert plan.count("Exchange") == 1


def test_append_keeps_rows_whole_and_null_keys_new(spark):
    path, kind = scratch_path(spark, "t-append"), "k string, n long, a string, b long"
    first = spark.createDataFrame([("x", 1, None, 5), ("x", 1, "p", None), (None, 1, "q", 1), ("y", None, "r", 2)], kind)
    append_new(spark, first, path, ["k", "n"], deal=["n"])
    got = rows(spark.read.parquet(path).where("k = 'x'").select("b", "a"))
    assert got in ([(5, None)], [(None, "p")])
    append_new(spark, first.unionByName(spark.createDataFrame([("z", 3, "s", 4)], kind)), path, ["k", "n"], deal=["n"])
    back = spark.read.parquet(path)
    assert back.columns == ["k", "n", "a", "b"]
    assert sorted((r.k or "-", r.n or 0) for r in back.collect()) == [
        ("-", 1), ("-", 1), ("x", 1), ("y", 0), ("y", 0), ("z", 3)]


def test_append_of_keys_alone_and_of_one_more_column(spark):
    for kind, old, new in (("k long", [(1,), (1,)], [(1,), (2,)]), ("k long, v long", [(1, 7), (1, 7)], [(1, 7), (2, None)])):
        path = scratch_path(spark, "t-append")
        append_new(spark, spark.createDataFrame(old, kind), path, ["k"])
        append_new(spark, spark.createDataFrame(new, kind), path, ["k"])
        assert rows(spark.read.parquet(path)) == sorted({*old, *new})


def test_signs_are_looked_up_with_the_words(spark):
    docs = spark.createDataFrame([(1, "apple pear apple"), (2, "pear plum"), (3, "cherry")], "doc_id long, text string")
    a = entries(materialize(build_index(docs, LATIN), scratch_path(spark, "t-signs")), probes=40)
    want, got = {}, {r.doc_id: r for r in probe(a, 40).collect()}
    for r in a.collect():
        digits = "".join(hashlib.md5(f"{r.term}:{d}".encode()).hexdigest() for d in range(2))
        assert [(r[f"_s{c // 32}"] >> c % 32) & 1 for c in range(40)] == [int(x >= "8") for x in digits[:40]]
        for c in range(40):
            want[r.doc_id, c] = want.get((r.doc_id, c), 0.0) + (r.w if digits[c] < "8" else -r.w)
    assert all(abs(got[d][f"y{c}"] - v) < 1e-12 for (d, c), v in want.items())


def test_only_repeated_keys_are_merged(spark):
    def words(docs):
        return doc_words(spark.createDataFrame(docs, "doc_id long, text string"), LATIN)
    assert "Exchange" not in plan_of(merged_repeats(words([(1, "a b a"), (2, "b"), (None, "c")])))
    twice = words([(1, "a b a"), (2, "b"), (1, "a c"), (None, "c"), (None, "c d"), (3, "")])
    got, want = (sorted(map(str, p.collect())) for p in (merged_repeats(twice), merge_postings(postings_from_words(twice))))
    assert got == want
