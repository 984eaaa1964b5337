"""Quality classifier: held-out labels, word vectors, degenerate inputs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF01
from llm.helpers import AWKWARD, awkward, clashing, empty

from lexis.llm import quality as Q


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    return docs, labels, Q.fit(docs, labels)


def test_held_out_labels_are_told_apart(fitted):
    docs, labels, model = fitted
    got = Q.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r["score"] for r in got if r["quality"] == 1])
    bad = np.array([r["score"] for r in got if r["quality"] == 0])
    auc = np.mean(good[:, None] > bad[None]) + np.mean(good[:, None] == bad[None]) / 2
    assert auc > 0.95 and (good >= Q.THRESHOLD).mean() > 0.95


def test_folds_and_predictions(fitted):
    docs, _, model = fitted
    for r in Q.score(docs, model).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_fit_does_not_depend_on_layout(spark, fitted):
    docs, labels, model = fitted
    again = Q.fit(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(model.first, again.first) and model.temperature == again.temperature


def test_contexts_are_sums_over_neighbours():
    place, sign = Q.index_vectors()
    seq = np.array([5, 9, 5, Q.PAD, Q.PAD, 3])
    table = np.zeros((Q.BUCKETS + 1) * Q.DIM)
    Q.add_contexts(table, seq, 2, place, sign)
    want = np.zeros((Q.BUCKETS + 1, Q.DIM))
    for i, w in enumerate(seq):
        for j in (i - 2, i - 1, i + 1, i + 2):
            if 0 <= j < len(seq):
                np.add.at(want[w], place[seq[j]], sign[seq[j]])
    assert np.array_equal(table.reshape(-1, Q.DIM)[:Q.BUCKETS], want[:Q.BUCKETS])


def test_word_vectors_over_a_corpus(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "a")], "doc_id long, text string")
    v = Q.word_vectors(docs)
    body, shape, sizes = Q.buckets_of(pa.array(["a b"]))
    place, sign = Q.index_vectors()
    want = np.zeros(Q.DIM)
    np.add.at(want, place[body[1]], sign[body[1]])
    assert np.allclose(v[body[0]], want / np.linalg.norm(want)) and sizes.tolist() == [2]


def test_pooling_is_a_mean_also_in_steps():
    rng = np.random.default_rng(0)
    table = rng.normal(size=(50, 4)).astype(np.float32)
    sizes = np.array([3, 0, 1, 300_000, 2, 0])
    seq = rng.integers(0, 50, sizes.sum())
    got, at = Q.pool(table, seq, sizes), 0
    for row, n in zip(got, sizes):
        want = table[seq[at:at + n]].mean(0) if n else np.zeros(4)
        assert np.allclose(row, want, atol=1e-4)
        at += n


def test_awkward_rows(spark, fitted):
    model = fitted[2]
    got = Q.score(awkward(spark), model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    empties = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert len(empties) == 1
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    docs = clashing(spark)
    kept = Q.keep_good(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert Q.score(empty(spark), model).count() == 0 and Q.keep_good(empty(spark), model).count() == 0


def test_labels_of_one_class_or_none(spark):
    labels = spark.createDataFrame([(1, 1), (5, 1), (7, None), (None, 0)], "doc_id long, quality int")
    m = Q.fit(awkward(spark), labels)
    assert all(r["score"] > 0.99 for r in Q.score(awkward(spark), m).collect())
    m = Q.fit(empty(spark), labels.limit(0))
    assert all(r["score"] == 0.5 for r in Q.score(awkward(spark), m).collect())


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-z))).astype(float)
    assert 2.5 < Q.fit_temperature(3 * z, y) < 3.5
