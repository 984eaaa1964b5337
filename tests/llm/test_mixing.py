"""Mixing: targets against step-by-step resharing, trades, near-target words."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import AWKWARD, SPACE_WORD, as_set, awkward, clashing, empty

from lexis.llm import mixing as M


def resharing(totals, share=1.5, repeats=2):
    """Targets by the contract's words: share by weight, cap, reshare."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(totals.values()), list(order)
    while open_ and left > 1e-9:
        w = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / w
        left = sum(max(0, target[s] - repeats * totals[s]) for s in open_)
        for s in open_:
            target[s] = min(target[s], repeats * totals[s])
        open_ = [s for s in open_ if target[s] < repeats * totals[s] - 1e-9]
    return target


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 50), st.floats(0.01, 0.99), st.integers(1, 50), st.floats(0.01, 0.99), st.floats(0, 0.999))
def test_trade_keeps_words_and_settles_one(sa, pa, sb, pb, u):
    a, b = M.trade(sa, pa, sb, pb, u)
    assert abs(sa * a + sb * b - sa * pa - sb * pb) < 1e-6
    assert a in (0.0, 1.0) or b in (0.0, 1.0)
    assert -1e-9 <= a <= 1 + 1e-9 and -1e-9 <= b <= 1 + 1e-9


def test_trade_keeps_expectations():
    rng, n = random.Random(1), 20_000
    got = [M.trade(7, 0.3, 3, 0.6, rng.random()) for _ in range(n)]
    assert abs(sum(a for a, _ in got) / n - 0.3) < 0.02
    assert abs(sum(b for _, b in got) / n - 0.6) < 0.02


def corpus(spark, n=600):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "en",
             "hot" if i % 3 == 0 else rng.choice(["a", "é", "Z", None, "b"]), 0) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("leaf,fan", [(4096, 64), (8, 2)])
def test_words_come_near_their_targets(spark, leaf, fan):
    rows, docs = corpus(spark)
    got = M.mix_table(docs, leaf_units=leaf, fan_in=fan).collect()
    size = {r[0]: len(SPACE_WORD.findall(r[1])) for r in rows}
    totals = defaultdict(int)
    for r in rows:
        totals[r[3]] += size[r[0]]
    want = resharing(totals)
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == totals[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    for s in totals:
        assert abs(taken[s] - want[s]) <= 60           # one document


def test_layout_does_not_change_the_mix(spark):
    _, docs = corpus(spark)
    one = as_set(M.mix_table(docs, leaf_units=16))
    assert one == as_set(M.mix_table(docs.repartition(9), leaf_units=16))


def test_mix_repeats_whole_rows(spark):
    _, docs = corpus(spark)
    copies = {r["doc_id"]: r["copies"] for r in M.mix_table(docs).collect()}
    got = M.mix(docs)
    assert got.columns == docs.columns
    seen = defaultdict(int)
    for r in got.collect():
        seen[r["doc_id"]] += 1
    assert seen == {d: c for d, c in copies.items() if c}


def test_awkward_rows(spark):
    got = M.mix_table(awkward(spark))
    assert got.count() == len(AWKWARD)
    sizes = {(r["doc_id"], r["size"]) for r in got.collect()}
    assert {(2, 0), (3, 0), (4, 0), (5, 1), (7, 60_000)} <= sizes
    one = [r["copies"] for r in got.where("doc_id = 1").collect()]
    assert len(one) == 2 and len(set(one)) == 1        # repeated rows share their copies
    assert M.mix(clashing(spark)).columns == clashing(spark).columns
    assert M.mix_table(empty(spark)).count() == 0 and M.mix(empty(spark)).count() == 0
