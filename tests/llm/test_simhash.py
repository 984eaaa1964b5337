"""SimHash groups against all pairs."""

import random

import pytest
import xxhash
from llm.helpers import AWKWARD, as_set, awkward, clashing, empty, lower

from lexis.llm import simhash as S
from lexis.llm.components import components


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def partition(pairs):
    groups = {}
    for node, root in pairs:
        groups.setdefault(root, set()).add(node)
    return sorted(map(sorted, groups.values()))


def test_fingerprints(spark):
    got = S.fingerprints(awkward(spark)).collect()
    want = sorted((r[0] or -1, brute_fingerprint(r[1])) for r in AWKWARD)
    assert sorted((r["doc_id"] or -1, r["fp"] % 2**64) for r in got) == want


def test_long_texts_are_read_in_chunks(monkeypatch):
    text = AWKWARD[7][1] + "\n\n  tail words"
    whole = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "CHUNK_BYTES", 37)
    assert S.fingerprint(text.encode()) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("segments,max_bits", [(3, 2), (4, 2), (7, 2), (9, 2), (5, 1)])
def test_every_near_pair_has_a_viable_chain(segments, max_bits):
    rng = random.Random(5)
    for _ in range(500):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, max_bits)))
        assert any(all(bin(x & mask).count("1") <= budget for mask, budget in
                       S.chain_masks(segments, max_bits, i)) for i in range(segments))


@pytest.mark.parametrize("bucket_pairs", [1, 3, 1000])
def test_links_join_what_all_pairs_join(spark, bucket_pairs):
    rng = random.Random(8)
    fps = {rng.getrandbits(64) for _ in range(40)}
    centre = rng.getrandbits(64)
    for _ in range(150):                               # a dense family
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    for f in list(fps)[:30]:
        fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [f - 2**64 if f >> 63 else f for f in fps] + [0]
    df = spark.createDataFrame([(f,) for f in set(signed)], "fp long")
    got = {r["node"]: r["root"] for r in components(S.links(df, bucket_pairs=bucket_pairs)).collect()}
    want = brute_components(set(signed))
    assert partition((f, got.get(f, f)) for f in want) == partition(want.items())


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(50)]
    edges = spark.createDataFrame(path + star + [(7, 7), (3, 4), (None, 5)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 151)}
    assert components(edges.limit(0)).count() == 0


def test_groups_and_survivors(spark):
    near = AWKWARD[7][1] + " extra"
    docs = awkward(spark).union(spark.createDataFrame([(70, near, "en", "a", 0)], awkward(spark).schema))
    g = {(r["doc_id"], r["component_id"]) for r in S.groups(docs).collect()}
    fps = {r[0]: brute_fingerprint(r[1]) for r in AWKWARD} | {70: brute_fingerprint(near)}
    roots = brute_components(set(fps.values()))
    first = {}
    for d, f in fps.items():
        if d is not None:
            first[roots[f]] = min(first.get(roots[f], d), d)
    assert g == {(d, first[roots[f]] if roots[f] in first else None) for d, f in fps.items()}
    kept = [r["doc_id"] for r in S.keep_one(docs).collect()]
    assert len(kept) == len(set(roots.values())) and 70 not in kept and kept.count(1) == 1


def test_clashing_columns_and_empty_tables(spark):
    docs = clashing(spark)
    assert S.keep_one(docs).columns == docs.columns
    assert as_set(S.keep_one(docs), "doc_id") == as_set(S.keep_one(awkward(spark)), "doc_id")
    assert S.groups(empty(spark)).count() == 0 and S.keep_one(empty(spark)).count() == 0
