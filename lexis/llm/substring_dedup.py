"""Repeated passages by unit hashing.

A text is cut into units of two kinds. Line units are lines, further cut after
sentence ends, of ``min_words`` words or more. Pieces are windows of ``PIECE``
words that ignore lines and punctuation, winnowed: of every ``WINDOW``
neighbouring windows the one of smallest rolling hash is taken, so which are
taken depends on the words around them alone. Any passage of ``PIECE + WINDOW
- 1`` = 31 words or more yields the same pieces wherever it stands, and they
cover it but for ``WINDOW - 1`` = 15 words at each end at most.

Units are normalised (Unicode-folded case, words only) and hashed to 128 bits;
of each digest the earliest occurrence stays, by (doc_id, place in the text),
and all others are removed. Units keep their character offsets in the original
text. A piece that overlaps its own earliest occurrence is removed from the end
of that occurrence on. Line units and pieces are never compared with each other.

Short sentences repeat by chance. So a sentence inside a line goes only as part
of a stretch of ``MIN_STRETCH`` words or more, or next to such a stretch that
came from the same document; a unit goes by itself where it is a whole line,
here or where it stands first.

Earliest places are minima, aggregated before they shuffle, so a passage that
a third of all documents share is one row per task. Only digests that occur
twice go on to the second step, where a unit meets its digest's earliest place.

Defined cases: null and empty texts have no units; a line unit of fewer than
``min_words`` words goes only where pieces cover it; rows that repeat doc_id
and text are one document; null doc_ids come last; ties cannot arise within a
document, its units are numbered; an empty table gives an empty result; other
columns are ignored, or kept by ``remove_repeats``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import (broadcast_if_small, matched, replace_text, saved, text_slices,
                              whole_rows)

MIN_WORDS = 5
#: Words of a stretch that goes though no whole line repeats in it.
MIN_STRETCH = 16
#: Units cut at line feeds, and after sentence ends within a line.
UNIT = re.compile(r"[^\n]+?(?:[.!?。]+(?=\s|$)|(?=\n)|$)", re.M)
PARAGRAPH = re.compile(r"[^\n](?:.*?)(?=\n\s*\n|\Z)", re.S)
LINE = re.compile(r"[^\n]+")
_WORD = re.compile(r"\w+")

#: Words of a piece (a power of two), and neighbouring pieces of which one is taken.
PIECE, WINDOW = 16, 16
_BASE = 0x9E3779B97F4A7C15

UNITS = ("doc_id long, text_hash long, piece boolean, whole boolean, unit int, start int, end int, n_words int, "
         "word int, d1 long, d2 long")
_TYPES = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int32()] * 5)
#: Digests of pieces, so that no piece has the digest of a line unit.
_PIECE_SEED = 1


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    """For each code point, whether a word holds it."""
    table = np.zeros(sys.maxunicode + 1, bool)
    table[_codes("".join(_WORD.findall("".join(map(chr, range(sys.maxunicode + 1))))))] = True
    return table


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word's case-folded characters."""
    inside = _word_table()[_codes(text)]
    starts, ends = _runs(inside)
    folded = text.casefold()
    if len(folded) == len(text):        # each character folds to one
        codes, sizes = _codes(folded)[inside], ends - starts
    else:
        words = [w.casefold() for w in _WORD.findall(text)]
        codes, sizes = _codes("".join(words)), np.fromiter(map(len, words), np.int64, len(words))
    if not len(sizes):
        return starts, ends, np.zeros(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    powers = np.full(sizes.max(), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    h = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1))
                        * powers[np.arange(len(codes)) - np.repeat(first, sizes)], first)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return starts, ends, h ^ (h >> np.uint64(32))


def _sliding(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` over every ``width`` neighbours; ``width`` is a power of two."""
    step = 1
    while step < width:
        x, step = f(x[:-step], x[step:]), 2 * step
    return x


def _winnowed(words: np.ndarray) -> np.ndarray:
    """First words of the pieces taken from a text of at least PIECE words."""
    h, step, power = words, 1, _BASE
    while step < PIECE:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % (1 << 64)
    if len(h) < WINDOW:
        return np.array([h.argmin()])
    edge = np.zeros(WINDOW - 1, np.uint64)
    least = np.concatenate([edge, _sliding(np.minimum, h, WINDOW), edge])
    return np.flatnonzero(_sliding(np.maximum, least, WINDOW) == h)


def _units(pattern: re.Pattern, min_words: int, pieces: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                chunks: list[list[np.ndarray]] = [[] for _ in _TYPES]
                docs: list[list] = [[], []]
                digests = []

                def add(d, h, piece, whole, *cols):
                    n = len(cols[0])
                    docs[0] += [d] * n
                    docs[1] += [h] * n
                    chunks[2].append(np.full(n, piece))
                    chunks[3].append(whole)
                    for c, x in zip(chunks[4:], cols):
                        c.append(np.asarray(x, np.int32))

                for d, h, text in zip(*(part.column(c).to_pylist()
                                        for c in ("doc_id", "text_hash", "text"))):
                    text = text or ""
                    spans = [m.span() for m in pattern.finditer(text)]
                    starts, ends, ids = _words(text)
                    raw = ids.tobytes()
                    if spans:
                        # a unit's words, by number: those that start in it
                        at, to = np.array(spans, np.int64).T
                        lo, hi = np.searchsorted(starts, at), np.searchsorted(starts, to)
                        n = np.flatnonzero(hi - lo >= min_words)
                        if len(n):
                            digests += [xxh3_128_digest(raw[i:j]) for i, j in zip((8 * lo[n]).tolist(),
                                                                                 (8 * hi[n]).tolist())]
                            whole = np.array([(i == 0 or text[i - 1] == "\n") and text[j:j + 1] in ("", "\n")
                                              for i, j in zip(at[n].tolist(), to[n].tolist())])
                            add(d, h, False, whole, n, at[n], to[n], (hi - lo)[n], lo[n] if pieces else np.zeros(len(n)))
                    if not pieces:
                        continue
                    if len(starts) >= PIECE:
                        at = _winnowed(ids)
                        add(d, h, True, np.zeros(len(at), bool), at, starts[at], ends[at + PIECE - 1], np.full(len(at), PIECE), at)
                        digests += [xxh3_128_digest(raw[i:i + 8 * PIECE], _PIECE_SEED) for i in (8 * at).tolist()]
                raw = pa.py_buffer(b"".join(digests))
                both = pa.Array.from_buffers(pa.int64(), 2 * len(digests), [None, raw]).to_numpy()
                cols = docs + [np.concatenate(c) if c else [] for c in chunks[2:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, _TYPES)]
                    + [pa.array(both[::2]), pa.array(both[1::2])],
                    ["doc_id", "text_hash", "piece", "whole", "unit", "start", "end", "n_words", "word",
                     "d1", "d2"])
    return run


def units(docs: DataFrame, pattern: re.Pattern = UNIT, min_words: int = MIN_WORDS,
          pieces: bool = False) -> DataFrame:
    """One row for each unit, with character offsets and digest (d1, d2), and
    with ``pieces`` one for each piece too (its unit is its first word)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_units(pattern, min_words, pieces), UNITS)


def _later(docs: DataFrame, pattern: re.Pattern, min_words: int, pieces: bool) -> DataFrame:
    """The units that are not the earliest of their digest, with its place ``p``."""
    all_units = units(docs, pattern, min_words, pieces)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "unit", "end", "whole")
    first = (all_units.groupBy("d1", "d2").agg(F.min(place).alias("p"), F.max(place).alias("q"))
                      .where("p <> q")
                      .select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "p"))
    first = broadcast_if_small(saved(first, "unit-firsts"), 128)
    found = all_units.join(first, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")))
    return found.where(place != F.col("p")).withColumn("first_doc_id", F.col("p.doc_id"))


def repeats(docs: DataFrame, pattern: re.Pattern = UNIT, min_words: int = MIN_WORDS) -> DataFrame:
    """The line units that are not the earliest of their digest, with the
    document that keeps it: (doc_id, text_hash, unit, start, end, n_words,
    first_doc_id)."""
    return (_later(docs, pattern, min_words, False)
            .select("doc_id", "text_hash", "unit", "start", "end", "n_words", "first_doc_id"))


def repeated_spans(docs: DataFrame, pattern: re.Pattern = UNIT,
                   min_words: int = MIN_WORDS, min_stretch: int = MIN_STRETCH) -> DataFrame:
    """Removed stretches: (doc_id, text_hash, start, end, n_units, n_words,
    first_doc_ids); neighbouring line units and overlapping units are joined.
    n_units counts line units and pieces, n_words the words removed. Fewer than
    ``min_words`` words before the first or after the last line unit of a
    stretch stay, as short line units do. A stretch of fewer than ``min_stretch``
    words goes only with a whole line in it or beside a longer one from the same
    document."""
    r = _later(docs, pattern, min_words, True).dropDuplicates(["doc_id", "text_hash", "piece", "unit"])
    own = F.col("piece") & F.col("p.doc_id").eqNullSafe(F.col("doc_id")) & (
        F.col("p.text_hash") == F.col("text_hash"))
    r = (r.withColumn("word_end", F.col("word") + F.col("n_words"))
          .withColumn("start", F.when(own, F.greatest("start", "p.end")).otherwise(F.col("start")))
          .withColumn("word", F.when(own, F.greatest(F.col("word"), F.col("p.unit") + PIECE))
                      .otherwise(F.col("word"))))
    of_doc = Window.partitionBy("doc_id", "text_hash")
    kinds = of_doc.orderBy("piece", "unit")
    next_line = ~F.col("piece") & (F.lag("unit").over(kinds) == F.col("unit") - 1)
    r = r.withColumn("from", F.when(next_line, F.lag("end").over(kinds)).otherwise(F.col("start")))
    before = of_doc.orderBy("from", "end", "piece").rowsBetween(Window.unboundedPreceding, -1)
    r = (r.withColumn("reach", F.max("end").over(before))
          .withColumn("seen", F.max("word_end").over(before))
          .withColumn("new", F.when((F.col("from") <= F.col("reach"))
                                    | (F.col("piece") & (F.col("word") <= F.col("seen"))), 0).otherwise(1))
          .withColumn("fresh", F.greatest(F.lit(0), F.col("word_end") - F.greatest("word", "seen"))))
    so_far = of_doc.orderBy("from", "end", "piece").rowsBetween(Window.unboundedPreceding, 0)
    line = ~F.col("piece")
    runs = (r.withColumn("run", F.sum("new").over(so_far)).groupBy("doc_id", "text_hash", "run")
             .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                  F.min(F.when(line, F.col("start"))).alias("line_start"),
                  F.max(F.when(line, F.col("end"))).alias("line_end"),
                  (F.min(F.when(line, F.col("word"))) - F.min("word")).alias("head"),
                  (F.max("word_end") - F.max(F.when(line, F.col("word_end")))).alias("tail"),
                  F.max(line & (F.col("whole") | F.col("p.whole"))).alias("whole"),
                  F.count(F.lit(1)).alias("n_units"), F.sum("fresh").alias("n_words"),
                  F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids")))
    short_head, short_tail = F.col("head") < min_words, F.col("tail") < min_words
    cut = runs.select(
        "doc_id", "text_hash", F.when(short_head, F.col("line_start")).otherwise(F.col("start")).alias("start"),
        F.when(short_tail, F.col("line_end")).otherwise(F.col("end")).alias("end"), "n_units",
        (F.col("n_words") - F.when(short_head, F.col("head")).otherwise(0)
         - F.when(short_tail, F.col("tail")).otherwise(0)).alias("n_words"), "first_doc_ids", "whole")
    in_text = of_doc.orderBy("start", "end")
    long = F.col("n_words") >= min_stretch
    beside = [F.coalesce(at(long).over(in_text)
                         & F.arrays_overlap("first_doc_ids", at("first_doc_ids").over(in_text)), F.lit(False))
              for at in (F.lag, F.lead)]
    return (cut.withColumn("goes", long | F.col("whole") | beside[0] | beside[1])
               .where("goes").drop("goes", "whole"))


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the removed stretches cut out of ``text``."""
    spans = (repeated_spans(docs, **options).groupBy("doc_id", "text_hash")
             .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
    joined = matched(whole_rows(docs), spans, "left").withColumn("text", F.col("row.text"))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
    cut = F.aggregate("spans", zero, lambda s, x: F.struct(
        x["end"].alias("at"),
        F.concat(s["kept"], F.substring(F.col("text"), s["at"] + 1, x["start"] - s["at"])).alias("kept")),
        lambda s: F.concat(s["kept"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return replace_text(joined, F.when(F.col("spans").isNotNull(), cut).otherwise(F.col("text")))
