"""Token id shards: ids equal the tokenizer's on whole texts, blocks round-trip."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import AWKWARD, awkward, clashing, empty
from tokenizers import Tokenizer

from lexis.llm import token_ids as T
from lexis.llm.registry import tokenizer_json, token_digests
from lexis.session import scratch_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=400), st.sampled_from([1., 50., 95., 100.]))
def test_block_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    assert (T.unpack_block(T.pack_block(ids, percentile)) == ids).all()


@pytest.mark.parametrize("ids", [[7], [5] * 1000, list(range(T.BLOCK_IDS)), [1] * 999 + [2**32 - 1]])
def test_block_edges(ids):
    ids = np.array(ids, np.uint32)
    assert (T.unpack_block(T.pack_block(ids)) == ids).all()


def test_few_large_ids_do_not_widen_a_block():
    ids = np.array([3] * 980 + [2**31] * 20, np.uint32)
    assert len(T.pack_block(ids)) < 200


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abzABZéÉñßÀ.,'!|<>0 \t\n\u00a0\u2003\u0301\u0130ΣΩдЖ中")),
                        max_size=40), max_size=4))
def test_encoder_equals_the_tokenizer_on_whole_texts(texts):
    import pyarrow as pa
    encoder, plain = _encoders()
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(sizes) == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def _encoders(made=[]):
    if not made:
        made.extend([T._Encoder(tokenizer_json()), Tokenizer.from_str(tokenizer_json())])
    return made


def test_cache_restarts_without_changing_ids(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(T, "CACHE_WORDS", 50)
    encoder, plain = T._Encoder(tokenizer_json()), _encoders()[1]
    for k in range(5):
        texts = [" ".join(f"w{k}x{i}," for i in range(30)), "the same words again."]
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == [i for e in plain.encode_batch(texts, add_special_tokens=False) for i in e.ids]


def want_digests(rows):
    tok = Tokenizer.from_str(tokenizer_json())
    out, at = [], 0
    for doc, ids in rows:
        raw = np.array(ids + [2], "<u4")
        out.append((doc, at, len(raw), zlib.crc32(raw.tobytes())))
        at += len(raw)
    return out


@pytest.mark.parametrize("make", [awkward, clashing])
def test_round_trip_through_files(spark, make):
    tok = Tokenizer.from_str(tokenizer_json())
    got = sorted((tuple(r) for r in token_digests(make(spark)).collect()), key=lambda r: r[1])
    rows = sorted(((r[0], r[1] or "") for r in AWKWARD), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = want_digests([(d, tok.encode(t, add_special_tokens=False).ids) for d, t in rows])
    assert got == want


def test_ids_and_random_access(spark):
    path = scratch_path(spark, "ids")
    T.write_token_ids(awkward(spark), path, tokenizer_json(), shards=2)
    tok = Tokenizer.from_str(tokenizer_json())
    by_id = {r[0]: r[1] or "" for r in AWKWARD}
    for r in T.read_token_ids(spark, path).collect():
        assert r["ids"] == tok.encode(by_id[r["doc_id"]], add_special_tokens=False).ids + [2]
    for m in spark.read.parquet(f"{path}/manifest").collect():
        whole = list(T.read_shard(f"{path}/shards", m["file"], m["n_bytes"]))
        assert len(whole) == m["n_docs"]
        for k in range(m["n_docs"]):
            (doc, at, ids), = T.read_shard(f"{path}/shards", m["file"], m["n_bytes"], k, 1)
            assert (doc, at, ids.tolist()) == (whole[k][0], whole[k][1], whole[k][2].tolist())


def test_empty_table(spark):
    assert token_digests(empty(spark)).collect() == []


def test_other_tokenizers_encode_whole_texts():
    import pyarrow as pa
    raw = tokenizer_json("byte_bpe_50k.json")
    texts = ["Hello  world.\n", "it's  a test ", ""]
    ids, sizes = T._Encoder(raw).encode(pa.array(texts))
    want = [e.ids for e in Tokenizer.from_str(raw).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for w in want for i in w] and list(sizes) == [len(w) for w in want]
