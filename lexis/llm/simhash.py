"""SimHash near-duplicates with pigeonring candidate filtering.

A document's fingerprint has a bit set where more than half of its shingles'
XXH64 hashes have it set. Documents whose fingerprints differ in at most
``max_bits`` bits are linked; links chain into components.

Candidates come from the pigeonring principle. The 64 bits form a ring of m
segments. If two fingerprints differ in at most t bits, some segment of the
ring starts a chain whose first l segments differ in at most l*t/m bits, for
every l. The budgets of the first segments are below one, so those segments
are equal: that run is the bucket key (m rotations). Inside a bucket a pair
must stay within the budgets of every longer chain before its full Hamming
distance is counted.

Buckets of up to ``bucket_pairs`` fingerprints are paired in their own row.
In larger ones (a family of near copies) no pairs are made: two fingerprints
differ in at most two bits exactly if some 64-bit value differs from each in
at most one, so every fingerprint names itself and its 64 one-bit neighbours,
and those that name the same value are linked. ``max_bits`` is 0, 1 or 2.

Defined cases: null and wordless texts have fingerprint zero and link like any
other; null doc_ids are never a component's id unless it has no other; repeated
rows share a fingerprint; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import ASCII_LOWER, matched, saved, text_slices, whole_rows
from lexis.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 7
BUCKET_PAIRS = 24
CHUNK_BYTES = 1 << 20

FINGERPRINTS = "doc_id long, text_hash long, fp long"
_SPACE = re.compile(rb"[ \t\n\v\f\r]")
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)


# --- fingerprints -----------------------------------------------------------

def _word_runs(text: bytes) -> Iterator[list[bytes]]:
    """Words of the text, about ``CHUNK_BYTES`` at a time."""
    at = 0
    while at < len(text):
        end = at + CHUNK_BYTES
        found = _SPACE.search(text, end) if end < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    from xxhash import xxh64_intdigest as digest
    counts, n, kept = np.zeros((8, 256), np.int64), 0, []

    def count(shingles) -> int:
        h = np.fromiter([digest(s, SEED) for s in shingles], np.uint64)
        lanes = h.view(np.uint8).reshape(-1, 8) + _LANES
        counts.ravel()[:] += np.bincount(lanes.ravel(), minlength=2048)
        return len(h)

    for words in _word_runs((text or b"").translate(ASCII_LOWER)):
        words = kept + words
        if len(words) >= shingle:
            n += count(map(b" ".join, zip(*[words[i:] for i in range(shingle)])))
            kept = words[len(words) - shingle + 1:]
        else:
            kept = words
    if n == 0 and kept:
        n = count([b" ".join(kept)])
    if n == 0:
        return 0
    ones = (counts @ _BYTE_BITS).ravel()              # bit 8 * byte + bit, little end first
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(fps)],
                    ["doc_id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; fp is the signed 64-bit value."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), FINGERPRINTS)


# --- links ------------------------------------------------------------------

def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ring(segments: int) -> list[int]:
    """Bit masks of the ring's segments, of nearly equal width."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def chain_masks(segments: int, max_bits: int, start: int) -> list[tuple[int, int]]:
    """(bits of the first l segments from ``start``, their budget) for every
    l at which the budget rises next; the first budget is 0."""
    parts, union, out = ring(segments), 0, []
    for length in range(1, segments + 1):
        union |= parts[(start + length - 1) % segments]
        budget = length * max_bits // segments
        if length == segments or (length + 1) * max_bits // segments > budget:
            out.append((union, budget))
    return out


def _differ(a: str, b: str, mask: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)).bitwiseAND(F.lit(_signed(mask)).cast("long")))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Edges (a, b) whose components are those of the graph that joins
    distinct fingerprints (fp) at ``max_bits`` or fewer differing bits."""
    if not 0 <= max_bits < segments:
        raise ValueError("a ring needs more segments than differing bits")
    chains = [chain_masks(segments, max_bits, i) for i in range(segments)]
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(
        F.lit(_signed(c[0][0])).cast("long")).alias("key")) for i, c in enumerate(chains)])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.i", "k.key")
    size = rows.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bucketed = saved(rows.join(size, ["i", "key"]), "simhash-buckets")

    # small buckets: all pairs of the row's own list, pruned along the chain
    few = (bucketed.where(F.col("n") <= bucket_pairs).groupBy("i", "key")
                   .agg(F.collect_list("fp").alias("fps")))
    pairs = (few.select("i", "fps", F.explode("fps").alias("a"))
                .select("i", "a", F.explode(F.filter("fps", lambda x: x > F.col("a"))).alias("b")))
    within = F.lit(False)
    for i, chain in enumerate(chains):
        ok = F.col("i") == i
        for mask, budget in chain[1:]:                 # the last chain is the whole ring
            ok = ok & (_differ("a", "b", mask) <= budget)
        within = within | ok
    near = pairs.where(within).select("a", "b")

    # large buckets: neighbours meet at shared one-bit variants
    many = bucketed.where(F.col("n") > bucket_pairs).select("fp").distinct()
    if max_bits == 1:
        flips = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << b)).cast("long")) for b in range(64)]
        other = many.select("fp", F.explode(F.array(*flips)).alias("g"))
        met = other.join(many.select(F.col("fp").alias("g")), "g")
        return near.unionByName(met.select(F.col("fp").alias("a"), F.col("g").alias("b")))
    if max_bits == 2:
        flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << b)).cast("long"))
                                 for b in range(64)]
        hubs = (many.select("fp", F.explode(F.array(*flips)).alias("hub"))
                    .groupBy("hub").agg(F.collect_list("fp").alias("fps"))     # 65 at most
                    .where(F.size("fps") > 1))
        met = hubs.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        return near.unionByName(met.where("a <> b").distinct())
    raise ValueError("max_bits up to 2 are supported")


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row: component_id
    is the smallest doc_id reachable, root a fingerprint that names the
    component."""
    fp = saved(fingerprints(docs, shingle), "simhash-fps")
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = saved(distinct, "simhash-distinct")
    root = components(links(distinct.select("fp"), max_bits, **options))
    named = (distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = saved(named, "simhash-roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return fp.join(named.select("fp", "root").join(ids, "root"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group: of each component the
    one with the smallest doc_id (null last), then the smallest text hash;
    rows that repeat it are dropped."""
    g = groups(docs, shingle, max_bits, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    kept = (g.groupBy("root").agg(first.alias("k"))
             .select("k.doc_id", "k.text_hash"))
    rows = matched(whole_rows(docs), kept, "left_semi")
    return rows.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
