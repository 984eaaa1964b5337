"""Ids and texts against the sentencepiece library."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from conftest import SF01
from lexis.llm import pieces, registry
from tests.llm.helpers import AWKWARD, awkward, clashing, empty

PATH = public_tokenizers.path(registry.PIECE_MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(model):
    """Runs of spaces, joined pieces, any characters, code, repeats."""
    rng = random.Random(5)
    several = [t.replace("▁", " ") for t in model["trees"] if len(t) > 1]
    one = [t for t in model["trees"] if len(t) == 1] + list("\n\t\x00😀▁ ")
    for r in range(80):
        yield from (" " * r, " " * r + "x", "ab" + " " * r + "日c", "\n" + " " * r + "return")
    for _ in range(4000):
        yield "".join(rng.choice(several) for _ in range(rng.randint(1, 5)))
        yield "".join(rng.choice(one) for _ in range(rng.randint(1, 12)))
        yield "".join(rng.choice("aAe01=-_./(){}<>;:,* \n") for _ in range(rng.randint(1, 40)))
        yield "".join(rng.choice("abcdeinorst  ") for _ in range(rng.randint(1, 30)))
    yield from ("a" * 5000, "ab" * 3000, "=" * 777, "aaaab" * 300, "<s>", "</s> hi", "<0x0A>", "<unk>", " ", "")


def test_ids_of_the_library(model, library):
    t = pieces.Tables(model)
    for x in texts(model):
        assert np.frombuffer(t.text(x), "<i4").tolist() == library.encode(x), repr(x)


def test_small_caches_change_nothing(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 6)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    t = pieces.Tables(model)
    for x in ["one two three four five six seven eight nine ten one two"] * 3:
        assert np.frombuffer(t.text(x), "<i4").tolist() == library.encode(x)


def test_documents(spark, model, library):
    want = sorted(((r[0], library.encode(r[1] or "")) for r in AWKWARD), key=repr)
    for df in (awkward(spark), clashing(spark)):
        ids = pieces.encode(df, model)
        assert sorted(((r.doc_id, r.ids) for r in ids.collect()), key=repr) == want
        got = pieces.decode(ids, model).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
            ((r[0], library.decode(library.encode(r[1] or ""))) for r in AWKWARD), key=repr)
    assert pieces.decode(pieces.encode(empty(spark), model), model).collect() == []


def test_any_ids_decode_as_in_the_library(spark, model, library):
    rng = random.Random(3)
    rows = [[1, 2, 0, 15043, 0], [203, 198], [259, 15043], [1, 259, 15043], [13, 259, 15043], [0, 29871], [], None,
            [3 + b for b in "é▁日".encode()], [3 + 0xE2, 3 + 0x96, 15043]]
    rows += [[rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(1, 9))]
             for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in pieces.decode(df, model).collect()}
    for i, ids in enumerate(rows):
        assert got[i] == library.decode(ids or []), ids


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    got = {r.doc_id: tuple(r) for r in registry.QUERIES["op12_sentencepiece"](spark, SF01).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        assert got[d.doc_id] == (d.doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                 sha256(library.decode(ids).encode()).hexdigest())
