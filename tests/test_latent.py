"""Corpus-wide factors against numpy's SVD of the whole tf-idf matrix."""

import uuid

import numpy as np
import pytest

from lexis.operators.index import build_index, materialize, weighted_postings
from lexis.operators.latent import (_signs, by_word, entries, fit_latent, folded_queries, latent_search, load_latent,
                                     probe)
from lexis.operators import latent_blocks
from lexis.operators.latent_blocks import (OF_ROWS, OF_WORDS, coded, decoded, document_table, documents_of, factor, kept,
                                            signed, store_blocks, word_table, words_of)
from lexis.operators.tokens import parse_queries
from lexis.profile import LATIN
from lexis.session import scratch_path

TINY = [(1, "apple pear plum apple"), (2, "pear plum cherry"), (3, "granite basalt slate"), (4, "slate basalt marble"),
        (5, "violin cello harp violin"), (6, "harp cello flute apple"), (7, "granite marble slate pear"),
        (8, "flute flute violin"), (9, "plum cherry cherry apple"), (10, "")]


def indexed(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return materialize(build_index(df, LATIN), scratch_path(spark, "t-latent"))


def batch(spark, *texts):
    return parse_queries(spark.createDataFrame(list(enumerate(texts)), "query_id long, text string"), LATIN)


def full_svd(index):
    wp = weighted_postings(index).collect()
    docs, words = sorted({r.doc_id for r in wp}), sorted({r.term for r in wp})
    a = np.zeros((len(docs), len(words)))
    for r in wp:
        a[docs.index(r.doc_id), words.index(r.term)] = r.tf_idf
    return a, docs, words


def brute_force(index, text, rank, top=10):
    a, docs, words = full_svd(index)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    known = [words.index(w) for w in sorted(set(text.split())) if w in words]
    q = vt[:rank, known].sum(axis=1) / s[:rank]
    out = []
    for i, d in enumerate(docs):
        if a[i, known].any():
            norms = np.linalg.norm(q) * np.linalg.norm(u[i, :rank])
            out.append((d, float(q @ u[i, :rank] / norms) if norms else 0.0))
    return s[:rank], sorted(out, key=lambda x: (-round(x[1], 9), x[0]))[:top]


def topics(n=240, seed=5):
    """Documents of five topics of different weight, and common words."""
    rng = np.random.default_rng(seed)
    names = [[f"{t}{chr(97 + i)}{chr(97 + j)}" for i in range(3) for j in range(4)] for t in "vwxyz"]
    out = []
    for d in range(n):
        t = int(rng.choice(5, p=[.34, .26, .19, .13, .08]))
        words = list(rng.choice(names[t], 8 + 3 * t)) + ["shared"] * int(rng.integers(0, 2))
        words += list(rng.choice(names[int(rng.integers(5))], 1))
        out.append((d, " ".join(words)))
    return out


@pytest.mark.parametrize("rank,words_max", [(1, 0), (3, 5), (3, 200_000)])     # no, some, all words broadcast
def test_values_and_ranking_of_a_small_corpus(spark, rank, words_max):
    idx = indexed(spark, TINY)
    model = fit_latent(idx, scratch_path(spark, "t-fit"), rank=rank, words_max=words_max)
    for text in ("apple plum", "slate violin unheard", "harp"):
        s, want = brute_force(idx, text, rank)
        assert model.settled and model.values == pytest.approx(list(s), rel=1e-9)
        got = sorted((r["rank"], r.doc_id, r.score) for r in
                     latent_search(idx, model, batch(spark, text), metric="cosine").collect())
        assert [g[2] for g in got] == pytest.approx([w[1] for w in want], abs=1e-7)
        assert {g[1] for g in got} == {w[0] for w in want}


def test_more_dimensions_than_probes_converge(spark):
    idx = indexed(spark, topics())
    model = fit_latent(idx, scratch_path(spark, "t-fit"), rank=4, probes=8, tolerance=1e-9)
    s, want = brute_force(idx, "vaa wab xac", 4, top=1000)
    assert model.settled and model.values == pytest.approx(list(s), rel=1e-7)
    got = {r.doc_id: r.score for r in
           latent_search(idx, model, batch(spark, "vaa wab xac"), k=1000, metric="cosine").collect()}
    assert got == pytest.approx(dict(want), abs=1e-3)


def test_steps_that_end_early_are_told(spark):
    model = fit_latent(indexed(spark, topics(60)), scratch_path(spark, "t-fit"), rank=4, probes=6, max_steps=1)
    assert not model.settled and model.rank == 4


def test_factors_are_read_back(spark):
    idx, path = indexed(spark, TINY), scratch_path(spark, "t-fit")
    model, q = fit_latent(idx, path, rank=2), batch(spark, "apple harp")
    again = load_latent(spark, path)
    assert again.values == model.values and again.settled
    assert latent_search(idx, again, q).collect() == latent_search(idx, model, q).collect()


def test_no_weight_and_no_documents(spark):
    same = indexed(spark, [(1, "one word"), (2, "one word"), (3, "word one")])
    model = fit_latent(same, scratch_path(spark, "t-fit"))
    assert model.rank == 0
    got = latent_search(same, model, batch(spark, "word")).collect()
    assert sorted((r.doc_id, r.score) for r in got) == [(1, 0.0), (2, 0.0), (3, 0.0)]
    empty = indexed(spark, [(1, "")])
    model = fit_latent(empty, scratch_path(spark, "t-fit"))
    assert model.rank == 0 and latent_search(empty, model, batch(spark, "word")).count() == 0


def test_unknown_words_and_bad_sizes(spark):
    idx = indexed(spark, TINY)
    model = fit_latent(idx, scratch_path(spark, "t-fit"), rank=2)
    assert latent_search(idx, model, batch(spark, "unheard")).count() == 0
    a, b = (folded_queries(model, batch(spark, t)).first().asDict() for t in ("apple", "apple unheard"))
    assert a == b
    for wrong in ({"rank": 0}, {"rank": 9, "probes": 8}, {"max_steps": 0}):
        with pytest.raises(ValueError):
            fit_latent(idx, scratch_path(spark, "t-fit"), **wrong)


def test_a_search_reads_the_postings_once(spark):
    idx = indexed(spark, TINY)
    model = fit_latent(idx, scratch_path(spark, "t-fit"), rank=2)
    plan = latent_search(idx, model, batch(spark, "apple harp"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<term:string,doc_id:bigint>") == 1


def test_a_step_moves_words_and_documents_but_no_postings(spark):
    idx, name = indexed(spark, topics(60)), f"t_blocks_{uuid.uuid4().hex[:8]}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")          # more tasks, not more parts
    try:
        a = store_blocks(idx, scratch_path(spark, "t-blocks"), name, _signs(4), 0)
        assert len(a.parts) == len(set(a.parts)) == spark.sparkContext.defaultParallelism
        path = scratch_path(spark, "t-probe")
        signed(a, 4, 32).write.parquet(path)
        y = spark.read.parquet(path)
        words = words_of(a, y, np.eye(4), keyed=True)
        docs = documents_of(a, words, 4)
        # the documents' rows by part, words' rows by group and back by part; never the table of entries
        plan = docs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
        moved = sum(len(r["keys"]) // 8 for r in words.collect())
        held = a.table.where("kind = 1").selectExpr("sum(octet_length(keys)) div 8 AS n").first().n
        assert moved == held <= len(a.parts) * idx.terms.count() < idx.postings.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_task_holds_one_group_of_words(spark, monkeypatch):
    for name, size in (("GROUP_WORDS", 4), ("TILE_ROWS", 50), ("PACK_ROWS", 70)):
        monkeypatch.setattr(latent_blocks, name, size)
    idx, name = indexed(spark, topics(60)), f"t_blocks_{uuid.uuid4().hex[:8]}"
    try:
        a = store_blocks(idx, scratch_path(spark, "t-blocks"), name, _signs(4), 0)
        assert len(a.groups) == -(-idx.terms.count() // 4) > len(a.parts)
        words = [len(r["keys"]) // 8 for r in a.table.where("kind = 1").collect()]
        assert len(words) > 2 * len(a.parts) and max(words) < idx.terms.count() // 2
        y = kept(a, signed(a, 4, 32), f"{name}_y", scratch_path(spark, "t-probe"))
        down = words_of(a, y, np.eye(4))
        assert down.select("group").distinct().count() > len(a.parts)
        # what the parts hold is read by part: nothing of it is dealt again in either product
        for df, exchanges in ((down, 1), (documents_of(a, down, 4, y, np.eye(4)), 2)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges
        want = {r.term: [r[f"z{i}"] for i in range(4)] for r in by_word(entries(idx, 4), probe(entries(idx, 4), 4)).collect()}
        keyed = words_of(a, y, np.eye(4), keyed=True)
        got = {r.term: [r[f"z{i}"] for i in range(4)] for r in word_table(a, keyed, np.eye(4), "z").collect()}
        assert set(got) == set(want) and all(got[t] == pytest.approx(want[t], abs=1e-9) for t in want)
    finally:
        for table in (name, f"{name}_y"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_words_of_one_part_stay_there(spark):
    docs = [(d, f"common own{chr(97 + d)} both{chr(97 + d // 2)}") for d in range(20)] + [(20, "other")]
    idx, name = indexed(spark, docs), f"t_blocks_{uuid.uuid4().hex[:8]}"
    try:
        a = store_blocks(idx, scratch_path(spark, "t-blocks"), name, _signs(4), 0)
        y = kept(a, signed(a, 4, 32), f"{name}_y", scratch_path(spark, "t-probe"))
        sent, every = (words_of(a, y, np.eye(4), keyed=k) for k in (False, True))
        rows = [sum(len(r["ones"]) for r in df.collect()) for df in (sent, every)]
        assert 0 < rows[0] <= rows[1] - 21                        # a document's own word is in one part
        own = documents_of(a, sent, 4, y, np.eye(4))
        got, want = ({r.doc_id: [r[f"x{i}"] for i in range(4)] for r in document_table(a, df, np.eye(4), "x").collect()}
                     for df in (own, documents_of(a, every, 4)))
        assert set(got) == set(want) and all(got[d] == pytest.approx(want[d], abs=1e-9) for d in want)
        for kind in (OF_ROWS, OF_WORDS):
            s, t = (np.linalg.svd(factor(a, df, kind, 4), compute_uv=False) for df in (own, documents_of(a, every, 4)))
            assert s == pytest.approx(t, rel=1e-9)
    finally:
        for table in (name, f"{name}_y"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_repeated_and_null_documents_are_one_row(spark):
    docs = [(1, "apple pear"), (1, "plum apple fig"), (2, "plum fig"), (None, "fig pear"), (3, "pear quince quince")]
    idx, name = indexed(spark, docs), f"t_blocks_{uuid.uuid4().hex[:8]}"
    try:
        a = store_blocks(idx, scratch_path(spark, "t-blocks"), name, _signs(2), 10)
        path = scratch_path(spark, "t-probe")
        signed(a, 2, 32).write.parquet(path)
        y = spark.read.parquet(path)
        want = {r.doc_id: (r.y0, r.y1) for r in probe(entries(idx, 2), 2).collect()}
        got = {r.doc_id: (r.y0, r.y1) for r in document_table(a, y, np.eye(2), "y").collect()}
        assert set(got) == set(want) == {1, 2, 3, None}
        assert all(got[d] == pytest.approx(want[d], abs=1e-12) for d in want)
        want = {r.term: (r.z0, r.z1) for r in by_word(entries(idx, 2), probe(entries(idx, 2), 2)).collect()}
        got = {r.term: (r.z0, r.z1) for r in word_table(a, words_of(a, y, np.eye(2), keyed=True), np.eye(2), "z").collect()}
        assert set(got) == set(want) and all(got[t] == pytest.approx(want[t], abs=1e-10) for t in want)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_rows_that_move_are_near_exact():
    z = np.random.default_rng(3).normal(size=(500, 16)) * 10.0 ** np.arange(-8, 8)
    z[0], z[1] = 0.0, -2.0 ** 7
    z[2:9] *= 1e-200
    back = decoded(coded(z).tobytes(), 16)
    assert np.all(np.abs(back - z) <= 2.0 ** -38 * np.abs(z).max(axis=1, keepdims=True))
    assert decoded(coded(np.zeros((0, 16))).tobytes(), 16).shape == (0, 16)
