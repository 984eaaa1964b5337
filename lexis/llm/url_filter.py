"""URL rules answered by Bloom filter cascades.

A rule is a host and a path: it fits the host and its subdomains where the
url's path starts with the rule's. A url's possible rules are therefore few
and known: each host suffix of as many labels as some rule has, with each path
prefix as long as some rule's. The longest listed one decides.

Whether a key is listed is answered without a join. Level 1 of a cascade is a
Bloom filter of the listed keys; level 2 holds the keys of the corpus that
level 1 takes by mistake; level 3 the listed keys that level 2 takes by
mistake; and so on until no mistake is left. Over the complete set of the
corpus's keys, for which it is built, the answer is exact: the first level
that lacks a key decides. Level 1 is as selective as makes its mistakes about
as many as the listed keys, so every level is bounded by the rule list, and
the cascade is broadcast whatever the size of the corpus.

Defined cases: a null url, or one without ``://``, has empty host and path and
no rule; an empty host fits none; hosts compare with A-Z lower-cased; a rule
listed as both is judged as blocked; repeated rows get a row each; no rules or
no rows give empty cascades; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import ascii_lower, broadcast_if_small, saved

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT = "allow"
KEY_BYTES = 256


def url_parts(url: str | Column = "url") -> tuple[Column, Column]:
    """(host, path): host between the first ``://`` and the next ``/``, ``?``
    or ``#``; path from there to ``?`` or ``#``."""
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    start = F.instr(u, "://")
    rest = F.when(start > 0, F.substr(u, start + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/?[^?#]*)", 1)
    return ascii_lower(host), path


def rule_keys(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Array of the url's possible rules, longest first."""
    labels = F.split(host, r"\.")
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p, _ in rules})
    keys = []
    for n, size in shapes:
        suffix = F.array_join(F.slice(labels, F.size(labels) - (n - 1), n), ".")
        fits = (host != "") & (F.size(labels) >= n) & (F.length(path) >= size)
        keys.append(F.when(fits, F.concat(suffix, F.substring(path, 1, size) if size else F.lit(""))))
    if not keys:
        return F.array().cast("array<string>")
    found = F.array_distinct(F.array_compact(F.array(*keys)))
    return F.array_sort(found, lambda a, b: F.length(b) - F.length(a))


@dataclass
class Level:
    seed: int
    bits: int
    hashes: int
    words: np.ndarray

    def has(self, keys: Sequence[str]) -> np.ndarray:
        at = _places(keys, self.seed, self.bits, self.hashes)
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def _places(keys: Sequence[str], seed: int, bits: int, hashes: int) -> np.ndarray:
    """Bit places of each key, by double hashing."""
    from xxhash import xxh3_128_intdigest
    h = [xxh3_128_intdigest(k.encode(), seed) for k in keys]
    a = np.fromiter((x & ((1 << 31) - 1) for x in h), np.int64, len(h))
    b = np.fromiter((x >> 64 & ((1 << 31) - 1) for x in h), np.int64, len(h))
    return (a[:, None] + np.arange(hashes) * (2 * b[:, None] + 1)) % bits


def _filter(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A Bloom filter of ``n`` keys: tasks send set bits, at most one row for
    each 64 bits reaches the driver."""
    bits = max(64, 64 * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / max(n, 1) * math.log(2))) if n else 1
    hashes = min(hashes, max(1, math.ceil(-math.log2(rate))))

    def run(batches):
        for batch in batches:
            at = _places(batch.column("key").to_pylist(), seed, bits, hashes).ravel()
            word, which = np.unique(at >> 6, return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, which, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_pydict({"word": pa.array(word),
                                              "bits": pa.array(value.view(np.int64))})

    rows = (keys.mapInArrow(run, "word long, bits long").groupBy("word")
                .agg(F.bit_or("bits")).collect())
    words = np.zeros(bits // 64, np.uint64)
    for w, x in rows:
        words[w] = np.uint64(x % (1 << 64))
    return Level(seed, bits, hashes, words)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(level.has(batch.column("key").to_pylist()), pa.bool_()))
    return keys.mapInArrow(run, "key string")


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels that tell ``listed`` (key) from the rest of ``universe`` (key),
    both of distinct keys."""
    inside = saved(listed, "cascade-listed")
    n, size = inside.count(), universe.count()
    if not n:
        return []
    outside = universe.join(broadcast_if_small(inside, KEY_BYTES), "key", "left_anti")
    rate = min(0.5, n / (math.sqrt(2) * max(size, 1)))
    levels: list[Level] = []
    while True:
        levels.append(_filter(inside, n, rate, len(levels)))
        wrong = saved(_passing(outside, levels[-1]), "cascade-level")
        n_wrong = wrong.count()
        if not n_wrong:
            return levels
        inside, outside, n, rate = wrong, inside, n_wrong, 0.5


def member(levels: Sequence[Level], keys: Sequence[str]) -> np.ndarray:
    """Whether each key of the universe is listed: the first level that lacks
    it is an even one, or none lacks it and their number is odd."""
    out = np.full(len(keys), bool(len(levels) % 2))
    open_ = np.arange(len(keys))
    for i, level in enumerate(levels):
        has = level.has([keys[j] for j in open_])
        out[open_[~has]] = bool(i % 2)
        open_ = open_[has]
    return out


def _judge(cascades, default: str):
    def run(batches):
        levels = cascades.value
        for batch in batches:
            lists = batch.column("keys").to_pylist()
            flat = [k for ks in lists for k in ks]
            named = {v: member(levels[v], flat) for v in levels}
            rule, verdict, at = [], [], 0
            for ks in lists:
                hit = next(((k, v) for j, k in enumerate(ks) for v in named if named[v][at + j]),
                           (None, default))
                rule.append(hit[0])
                verdict.append(hit[1])
                at += len(ks)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"),
                 pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])
    return run


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    spark = pages.sparkSession
    host, path = url_parts("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
                        path.alias("path"))
    rows = rows.withColumn("keys", rule_keys(F.col("host"), F.col("path"), rules))
    universe = saved(rows.select(F.explode("keys").alias("key")).distinct(), "cascade-keys")
    cascades = {}
    for verdict in ("block", "allow"):
        keys = sorted({h + p for h, p, v in rules if v == verdict})
        listed = spark.createDataFrame([(k,) for k in keys], "key string")
        cascades[verdict] = build_cascade(universe, listed)
    shared = spark.sparkContext.broadcast(cascades)
    return rows.mapInArrow(_judge(shared, default), "page_id long, host string, path string, "
                                                    "rule string, verdict string")
