"""Writes that fail, readers at work, merged frequencies, repeated keys."""

import pytest
from conftest import rows

from lexis.operators import store
from lexis.operators.index import build_index
from lexis.operators.store import load_index, read_version, save_index, vacuum, versions
from lexis.profile import LATIN
from lexis.session import scratch_path
from lexis.streaming.ingest import index_batch
from tests.test_index_store import DOCS, SCHEMA, frame, same


def build(spark, docs):
    return build_index(frame(spark, docs), LATIN)


def test_a_refused_overwrite_leaves_the_index(spark):
    path = scratch_path(spark, "refused")
    save_index(build(spark, DOCS), path)
    with pytest.raises(ValueError, match="repeats"):
        save_index(build(spark, [(1, "new words"), (1, "again new")]), path)
    same(load_index(spark, path), DOCS, spark)
    assert versions(spark, path) == [1]


@pytest.mark.parametrize("mode", ["overwrite", "append"])
@pytest.mark.parametrize("step", ["commit", "terms_from_postings", "docs_from_postings"])
def test_a_write_that_dies_leaves_the_index(spark, monkeypatch, mode, step):
    path = scratch_path(spark, "killed")
    save_index(build(spark, DOCS[:3]), path)

    def dies(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, step, dies)
        with pytest.raises(KeyboardInterrupt):
            save_index(build(spark, DOCS[3:]), path, mode=mode)
    same(load_index(spark, path), DOCS[:3], spark)
    vacuum(spark, path)
    same(save_index(build(spark, DOCS[3:]), path, mode="append"), DOCS, spark)


def test_readers_keep_the_version_they_opened(spark):
    path = scratch_path(spark, "reader")
    old = save_index(build(spark, DOCS[:2]), path)
    new = save_index(build(spark, DOCS[2:]), path, mode="append")
    same(old, DOCS[:2], spark)
    same(new, DOCS, spark)
    over = save_index(build(spark, DOCS[1:3]), path)
    same(new, DOCS, spark)                             # its files are kept for one more version
    same(over, DOCS[1:3], spark)
    same(load_index(spark, path, number=2), DOCS, spark)
    same(load_index(spark, path), DOCS[1:3], spark)


def test_two_writers(spark):
    path = scratch_path(spark, "writers")
    save_index(build(spark, DOCS[:2]), path)
    state = read_version(spark, path)
    store.commit(spark, path, state, state["number"])
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(spark, path, state, state["number"])


def test_frequencies_are_merged(spark, monkeypatch):
    monkeypatch.setattr(store, "MAX_DELTAS", 2)
    path = scratch_path(spark, "deltas")
    for k in range(len(DOCS)):
        i = save_index(build(spark, DOCS[k:k + 1]), path, mode="append")
        assert len(read_version(spark, path)["terms"]) <= 2
    same(i, DOCS, spark)
    # a batch whose frequencies are merged already is replaced
    index_batch(spark, frame(spark, [(20, "apple")]), path, LATIN, batch_id="s-0")
    index_batch(spark, frame(spark, [(21, "apple")]), path, LATIN, batch_id="s-1")
    index_batch(spark, frame(spark, [(20, "cherry")]), path, LATIN, batch_id="s-0")
    same(load_index(spark, path), [*DOCS, (20, "cherry"), (21, "apple")], spark)


def test_an_append_reads_only_batches_near_its_keys(spark, monkeypatch):
    path = scratch_path(spark, "near")
    save_index(build(spark, DOCS), path)
    read, plain = [], store.stored_docs

    def noted(spark, path, state, batches=None):
        read.append(None if batches is None else len(batches))
        return plain(spark, path, state, batches)

    monkeypatch.setattr(store, "stored_docs", noted)
    monkeypatch.setattr(store, "load_index", lambda *a: None)
    save_index(build(spark, [(100, "far away")]), path, mode="append")
    assert read == [1]                                 # its own
    with pytest.raises(ValueError, match="stored"):
        save_index(build(spark, [(3, "here")]), path, mode="append")


def test_one_rule_for_repeated_keys(spark):
    twice = [(1, "alpha beta"), (1, "gamma alpha"), (2, "beta"), (3, "7")]
    whole = [(1, "alpha beta gamma alpha"), (2, "beta"), (3, "7")]
    same(save_index(build(spark, twice), scratch_path(spark, "merge"), repeats="merge"), whole, spark)
    path = scratch_path(spark, "stream-merge")
    for _ in range(2):                                 # the second time as a replay
        index_batch(spark, frame(spark, twice), path, LATIN, batch_id="run-0")
        same(load_index(spark, path), whole, spark)
    with pytest.raises(ValueError, match="repeats"):
        index_batch(spark, frame(spark, [(9, "x y"), (9, "x z")]), path, LATIN, batch_id="run-1", repeats="refuse")
    index_batch(spark, frame(spark, [(2, "other"), (4, "new")]), path, LATIN, batch_id="run-1")
    same(load_index(spark, path), [*whole, (4, "new")], spark)
    assert [b["ignored"] for b in read_version(spark, path)["batches"]] == [0, 1]


def test_vacuum_removes_only_what_no_version_names(spark):
    path = scratch_path(spark, "vacuum")
    for k in range(3):
        save_index(build(spark, DOCS[k:k + 2]), path)
    assert versions(spark, path) == [2, 3]
    i = save_index(build(spark, DOCS[:2]), path, mode="append")
    vacuum(spark, path)
    assert versions(spark, path) == [4]
    same(i, DOCS[:4], spark)
    with pytest.raises(ValueError):
        load_index(spark, scratch_path(spark, "nothing-here"))


def test_empty_and_wordless(spark):
    path = scratch_path(spark, "wordless")
    i = save_index(build_index(spark.createDataFrame([], SCHEMA), LATIN), path)
    assert i.postings.count() == i.docs.count() == i.terms.count() == i.corpus.first().n_docs == 0
    index_batch(spark, frame(spark, [(5, "12 !")]), path, LATIN, batch_id="a")
    index_batch(spark, frame(spark, [(5, "late words")]), path, LATIN, batch_id="b")    # known: not retried
    assert rows(load_index(spark, path).postings) == []
