"""The pipeline: every stage against what its operator's brute force keeps."""

import pytest
from conftest import SF01
from llm.helpers import SPACE_WORD, clashing, empty
from llm.test_decontaminate import brute as contamination
from llm.test_simhash import brute_components, brute_fingerprint

import corpus_pipeline as C
from lexis.llm import registry


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES[:4]:
        out.append(C.saved(f(spark, out[-1], SF01), f"test-{name}"))
        assert out[-1].columns == docs.columns
    return [[r.asDict() for r in d.collect()] for d in out]


def test_stage_order():
    assert [f.__name__ for _, f in C.STAGES] == ["classify", "near_dedup", "decontaminated", "mixed", "token_shards"]


def test_classifier_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) > 0.97 * len(good)
    assert sum(d in kept for d in bad) < 0.3 * len(bad)


def test_one_of_each_group_stays(stages):
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in stages[1]}
    root = brute_components(set(fps.values()))
    first = {}
    for d in sorted(fps):
        first.setdefault(root[fps[d]], d)
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(first.values())


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    judged = contamination([(r["doc_id"], r["text"]) for r in stages[2]], items)
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(x[0] for x in judged if not x[5])
    assert any(x[5] for x in judged)


def test_mixed_rows_are_whole_copies(stages):
    by = {r["doc_id"]: r for r in stages[3]}
    size = lambda rows: sum(len(SPACE_WORD.findall(r["text"])) for r in rows)
    assert all(r == by[r["doc_id"]] for r in stages[4])
    assert abs(size(stages[4]) / size(stages[3]) - 1.5) < 0.05


def test_run_ends_in_token_ids(spark):
    got = C.run(spark, SF01).orderBy("start").collect()
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert got


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (clashing(spark), empty(spark)):
        for name, f in C.STAGES:
            out = f(spark, docs, SF01)
            assert name == "token_ids" or out.columns == docs.columns
            out.count()


def test_queries_are_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert names >= {"pipeline", *registry.QUERIES} and len(registry.QUERIES) == 13
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}
