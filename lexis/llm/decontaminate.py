"""Benchmark decontamination with DataFrame functions only.

A window is 13 consecutive words of a benchmark item (the whole item if it has
fewer). A document word is hit when it lies in an occurrence of a window.

Scanning every window of a corpus is not needed. With k = ceil(L / 2) and
s = L - k + 1, any L consecutive document words hold exactly one run of k
words that starts at a multiple of s. So only every s-th k-word run of a
document is hashed and looked up in the benchmark's k-word runs (a broadcast
set when its counted size is small). Around each hit the words themselves are
compared, as far as a window through the run can reach: case and accents
count, hash collisions do not.

Defined cases: null and wordless texts have no words and are clean; items with
null or wordless text, or null item_id, have no windows; items of equal words
share their windows and are all reported; repeated documents get a row each;
ties do not arise; empty tables give empty or clean results; other columns are
ignored, or kept by ``drop_contaminated`` and ``remove_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import (BROADCAST_BYTES, ascii_lower, broadcast_if_small, matched,
                              replace_text, saved, whole_rows)

WINDOW = 13
#: A document is contaminated when 1 / MIN_SHARE of its words or more are hit.
MIN_SHARE = 20

# Everything below 0x80 but letters and digits separates words.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ROW_BYTES = 1024


def words(text: str | Column) -> Column:
    """The words of a text, case kept (null: none)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR), "")


def run_hash(length: int, run: Column) -> Column:
    """Hash of a run of words. Full lower case is coarser than A-Z lower case,
    so equal runs have equal hashes; the words are compared afterwards."""
    return F.xxhash64(F.lit(length), F.lower(F.array_join(run, " ")))


def strides(length: int) -> tuple[int, int]:
    """(k, s) for windows of ``length`` words."""
    k = (length + 1) // 2
    return k, length - k + 1


def benchmark_runs(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, len, k, ids, left, right): one row for each k-word run of each
    distinct item: its hash, the window length, the ids of the items with
    these words, the run's words with those before it (nearest first) and the
    words after it, as far as a window reaches."""
    items = (benchmark.where(F.col("item_id").isNotNull())
                      .select(F.col("item_id").cast("string").alias("id"),
                              words(ascii_lower("text")).alias("w"))
                      .where(F.size("w") > 0).groupBy("w")
                      .agg(F.array_sort(F.collect_set("id")).alias("ids"))
                      .withColumn("len", F.least(F.size("w"), F.lit(window)))
                      .withColumn("k", F.floor((F.col("len") + 1) / 2).cast("int")))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1))
    runs = items.select("ids", "w", "len", "k", at.alias("q"))
    reach = F.col("len") - F.col("k")
    before = F.slice("w", F.greatest(F.col("q") - reach, F.lit(1)),
                     F.least(F.col("q") - 1, reach))
    return runs.select(
        F.xxhash64("len", F.lower(F.array_join(F.slice("w", F.col("q"), F.col("k")), " "))).alias("h"),
        "len", "k", "ids", F.slice("w", F.col("q"), F.col("k")).alias("run"),
        F.reverse(before).alias("left"),
        F.slice("w", F.col("q") + F.col("k"), F.greatest(reach, F.lit(1))).alias("right"))


def _agree(a: Column, b: Column) -> Column:
    """Number of leading words that are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise((first - 1).cast("int"))


def _lowered(words_: Column) -> Column:
    return F.transform(words_, ascii_lower)


def _grid(length: int) -> Column:
    """(p, h) of the runs to look up for windows of ``length`` words."""
    k, s = strides(length)
    starts = F.sequence(F.lit(1), F.size("words") - (k - 1), F.lit(s))
    return F.transform(starts, lambda p: F.struct(
        p.alias("p"), run_hash(length, F.slice("words", p, k)).alias("h")))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_hash, n_words, spans, ids) for every distinct (doc_id,
    text): hit spans as (from, to) word positions from 1, sorted, and the
    sorted ids of the items found."""
    runs = saved(benchmark_runs(benchmark, window), "benchmark-runs")
    lengths = sorted(r[0] for r in runs.select("len").distinct().collect())   # `window` at most
    small = runs.count() * _ROW_BYTES <= broadcast_bytes
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.xxhash64("text").alias("text_hash"), words("text").alias("words"))
    probe = "array<struct<p:int,h:bigint>>"
    grids = [F.array(F.struct(F.lit(0).alias("p"), F.lit(None).cast("long").alias("h"))).cast(probe)]
    for n in lengths:
        grid = F.when(F.size("words") >= n, _grid(n)).otherwise(F.array().cast(probe))
        grids.append(grid.cast(probe))
    d = d.select("doc_id", "text_hash", "words", F.size("words").alias("n_words"),
                 F.explode(F.concat(*grids)).alias("g"))
    d = d.select("doc_id", "text_hash", "words", "n_words", F.col("g.p").alias("p"), F.col("g.h").alias("dh"))
    reach = window                                   # at least len - k + k on either side
    first = F.greatest(F.col("p") - reach, F.lit(1))
    cut = F.when(F.col("p") > 0, F.slice("words", first, F.col("p") - first + 2 * reach))
    slim = ["doc_id", "text_hash", "n_words", "p", "first", "near"]
    if small:
        d = d.join(F.broadcast(runs), d.dh == runs.h, "left")
        hit = F.col("h").isNotNull()
        d = d.where(hit | (F.col("p") == 0)).withColumn("first", first).withColumn(
            "near", F.when(hit, cut))
    else:
        # the lookup shuffles, so a row carries only the words near its run
        d = d.withColumn("first", first).withColumn("near", cut).select(*slim, "dh")
        d = d.join(runs, d.dh == runs.h, "left").where(F.col("h").isNotNull() | (F.col("p") == 0))
    d = d.withColumn("near", _lowered(F.col("near"))).withColumn("o", F.col("p") - F.col("first"))
    beyond = F.col("len") - F.col("k")
    before = F.reverse(F.slice("near", F.greatest(F.col("o") - beyond + 1, F.lit(1)),
                               F.least(F.col("o"), beyond)))
    after = F.slice("near", F.col("o") + F.col("k") + 1, beyond)
    run = F.slice("near", F.col("o") + 1, F.col("k"))
    d = (d.withColumn("a", F.when(run == F.col("run"), _agree(before, F.col("left"))))
          .withColumn("b", F.when(run == F.col("run"), _agree(after, F.slice("right", F.lit(1), beyond)))))
    found = F.col("a") + F.col("k") + F.col("b") >= F.col("len")
    span = F.struct((F.col("p") - F.col("a")).alias("from"),
                    (F.col("p") + F.col("k") + F.col("b") - 1).alias("to"))
    return (d.groupBy("doc_id", "text_hash")
             .agg(F.max("n_words").cast("long").alias("n_words"),
                  F.array_sort(F.collect_set(F.when(found, span))).alias("spans"),
                  F.array_sort(F.array_distinct(F.flatten(
                      F.collect_set(F.when(found, F.col("ids")))))).alias("ids")))


def covered(spans: str | Column = "spans") -> Column:
    """Words in the union of sorted (from, to) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda s, x: F.struct(
        F.greatest(s["end"], x["to"]).alias("end"),
        (s["n"] + F.greatest(x["to"] - F.greatest(s["end"], x["from"] - 1), F.lit(0))).alias("n")),
        lambda s: s["n"])


def judge(scanned: DataFrame, min_share: int = MIN_SHARE) -> DataFrame:
    """The scan with n_hit, n_items, items_sha256 and contaminated."""
    out = (scanned.withColumn("n_hit", covered())
                  .withColumn("n_items", F.size("ids").cast("long"))
                  .withColumn("items_sha256", F.sha2(F.concat_ws(",", "ids"), 256)))
    return out.withColumn("contaminated", (F.col("n_hit") > 0)
                          & (F.col("n_hit") * min_share >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated."""
    found = judge(scan(docs, benchmark, **options))
    rows = whole_rows(docs.select("doc_id", "text")).select("doc_id", "text_hash")
    return matched(rows, found, "inner").select("doc_id", "n_words", "n_hit", "n_items",
                                                "items_sha256", "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    found = judge(scan(docs, benchmark, **options)).where("contaminated")
    bad = saved(found.select("doc_id", "text_hash"), "contaminated")
    return matched(whole_rows(docs), broadcast_if_small(bad, 32), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``; separators stay."""
    found = judge(scan(docs, benchmark, **options)).where("n_hit > 0").select(
        "doc_id", "text_hash", "spans")
    joined = matched(whole_rows(docs), found, "left").withColumn("text", F.col("row.text"))
    parts = F.regexp_extract_all("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|" + SEPARATOR),
                                 F.lit(0))
    lead = F.col("text").rlike("^" + SEPARATOR).cast("int")   # words are every other part

    def hit(i: Column) -> Column:
        word = F.floor((i - lead) / 2) + 1
        return ((i + lead) % 2 == 0) & F.exists("spans", lambda s: word.between(s["from"], s["to"]))

    cut = F.array_join(F.transform(parts, lambda x, i: F.when(hit(i), F.lit("")).otherwise(x)), "")
    return replace_text(joined, F.when(F.col("spans").isNotNull(), cut).otherwise(F.col("text")))
