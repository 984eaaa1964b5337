"""Decontamination against all windows."""

import hashlib
import re

import pytest
from conftest import SF001
from llm.helpers import as_set, awkward, clashing, empty, lower

from lexis.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "cat sat on"), (2, None), (None, "the mat"), (3, "..."), (4, "The CAT sat on"), (5, "fine"),
         (4, "The CAT sat on"), (6, " ".join(f"word{i}" for i in range(20, 60))), (7, "ÉÀ straße"),
         (8, "éà straße"), (9, " ".join(f"word{i}" for i in range(500, 512)))]


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(13, len(w))
        for a in range(len(w) - n + 1) if n and i is not None else ():
            wins.setdefault(tuple(w[a:a + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = WORD.findall(lower(t)), set(), set()
        for n in {len(k) for k in wins}:
            for a in range(len(w) - n + 1):
                if found := wins.get(tuple(w[a:a + n])):
                    hit |= set(range(a, a + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_awkward_documents_and_items(spark, broadcast_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = as_set(D.contamination(awkward(spark), items, broadcast_bytes=broadcast_bytes))
    assert got == brute([(r["doc_id"], r["text"]) for r in awkward(spark).collect()], ITEMS)


def test_fixture(spark):
    docs, items = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    want = brute(map(tuple, docs.select("doc_id", "text").collect()), list(map(tuple, items.collect())))
    assert as_set(D.contamination(docs, items)) == want and any(w[5] for w in want)


def test_removal(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    docs = clashing(spark)
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 5, 6, 7, 9, None}
    cut = D.remove_spans(docs, items)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[8] == "The    the mat. It was a fine, fine day." and texts[5] == "one" and texts[2] is None


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.contamination(empty(spark), items).count() == 0
    clean = D.contamination(awkward(spark), items.limit(0))
    assert clean.count() == 11 and clean.where("contaminated or n_hit > 0").count() == 0


def test_main_path_is_native(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = D.contamination(awkward(spark), items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
