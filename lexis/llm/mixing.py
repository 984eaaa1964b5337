"""Mixing sources to target weights by pivotal dependent rounding.

``source_targets`` shares a word budget among sources; ``mix`` turns each
source's target into a whole number of copies of every document. A document
of a source that should give r times its size (0 <= r <= 2) gets floor(r)
copies and, with inclusion mass frac(r), one more. Pivotal rounding settles
that mass: two undecided documents trade words at random, without changing
their sum or either one's expectation, until one of them holds 0 or 1. Each
trade moves size * mass, so a source's words stay on target throughout and
only its last undecided document rounds them.

The trades run as a reduction tree. Documents are dealt to leaves by a hash of
their key (a source of n documents has n / ``LEAF_UNITS`` leaves, so a hot
source is split like any other); a task walks its leaves as a stream and
leaves at most one undecided document in each; the undecided documents of
``FAN_IN`` leaves meet one level up. All randomness is a hash of (seed, level,
key): partitions and retries do not change the mix.

Defined cases: null text has size 0 and takes 0 words; null is a source of its
own, last in order; rows that repeat (doc_id, source, size) are one unit of
their joint size and share its copies; an empty table gives an empty mix;
other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import broadcast_if_small, saved, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
LEAF_UNITS = 4096
FAN_IN = 64
SEED = 20
#: Bytes of a source's row in memory, with room for its name.
SOURCE_ROW_BYTES = 512

_KEY = ["doc_id", "source", "size"]
_UNIT = "doc_id long, source string, size long, words long, base int, p double, leaf long"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): size in words of the whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       word_count("text").alias("size"))


def source_targets(units: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, n_units, source_size, target) from (source, words).

    ``share`` times all words is dealt out by the repeating weights; a target
    stops at ``max_repeats`` times its source, and the excess is dealt to the
    others by weight. Sources in order of cap / weight reach their caps one
    after the other as the level of a weight unit rises, so the final level
    follows from running sums; the windows see one row for each source.
    """
    per = units.groupBy("source").agg(F.count(F.lit(1)).alias("n_units"),
                                      F.sum("words").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = (per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (turn + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats))))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto, everything = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    per = (per.withColumn("caps", F.sum("cap").over(upto))
              .withColumn("left", F.greatest(F.sum("w").over(everything) - F.sum("w").over(upto),
                                             F.lit(0.0)))
              .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share))))
    full = F.col("caps") + F.col("cap") / F.col("w") * F.col("left") <= F.col("budget")
    per = (per.withColumn("full", full)
              .withColumn("caps_full", F.coalesce(F.sum(F.when(full, F.col("cap"))).over(everything),
                                                  F.lit(0.0)))
              .withColumn("w_open", F.sum(F.when(~full, F.col("w"))).over(everything)))
    level = F.try_divide(F.col("budget") - F.col("caps_full"), F.col("w_open"))
    target = F.when(F.col("full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), level * F.col("w")))
    return per.select("source", "n_units", "source_size", target.alias("target"))


def _uniform(level: int, seed: int) -> Column:
    """Uniform number in [0, 1) that depends on seed, level and unit only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(level), *_KEY), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def trade(size_a: float, p_a: float, size_b: float, p_b: float, u: float) -> tuple[float, float]:
    """One pivotal step: move words between a and b until one mass is 0 or 1.

    Keeps size_a * p_a + size_b * p_b, and both expectations.
    """
    up = min(size_a * (1 - p_a), size_b * p_b)        # words b can give a
    down = min(size_a * p_a, size_b * (1 - p_b))      # words a can give b
    moved = up if u * (up + down) < down else -down
    new_a, new_b = p_a + moved / size_a, p_b - moved / size_b
    return tuple(0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x for x in (new_a, new_b))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settle each leaf of a stream sorted by (source, leaf): a unit that is
    still undecided meets the next one; at most one is left."""
    held = None                                        # (leaf key, row, mass)
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            key, p = (row["source"], row["leaf"]), row["p"]
            if held and held[0] != key:
                out.append((held[1], held[2]))
                held = None
            if not 0 < p < 1:
                out.append((row, p))
            elif held is None:
                held = (key, row, p)
            else:
                p_held, p = trade(held[1]["words"], held[2], row["words"], p, row["u"])
                if 0 < p_held < 1:
                    out.append((row, p))
                    held = (key, held[1], p_held)
                else:
                    out.append((held[1], p_held))
                    held = (key, row, p)
                    if not 0 < p < 1:
                        out.append((row, p))
                        held = None
        yield _rows(out)
    if held:
        yield _rows([(held[1], held[2])])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "source", "size", "words", "base", "p", "leaf")
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64())
    cols = {n: pa.array([p if n == "p" else r[n] for r, p in out], t) for n, t in zip(names, types)}
    return pa.RecordBatch.from_pydict(cols)


def _settle(units: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the tree, as a saved table."""
    rows = units.withColumn("u", _uniform(level, seed))
    # larger documents first, so that what stays undecided is small
    order = ["source", "leaf", F.desc("words"), "doc_id", "size"]
    return saved(rows.repartition("source", "leaf").sortWithinPartitions(*order)
                     .mapInArrow(_walk, _UNIT), f"mix-level-{level}")


def copies(docs: DataFrame, seed: int = SEED, leaf_units: int = LEAF_UNITS, fan_in: int = FAN_IN,
           **targets) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row for each
    distinct (doc_id, source, size)."""
    slim = docs if "size" in docs.columns else sized(docs)
    units = slim.groupBy(*_KEY).agg((F.count(F.lit(1)) * F.col("size")).alias("words"))
    plan = saved(source_targets(units, **targets), "mix-plan")
    small = broadcast_if_small(plan.withColumnRenamed("source", "s"), SOURCE_ROW_BYTES)
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    base = F.floor(ratio).cast("int")
    leaf = F.pmod(F.xxhash64(F.lit(seed), *_KEY),
                  F.ceil(F.col("n_units") / F.lit(leaf_units)).cast("long"))
    fraction = F.col("ratio") - F.col("base")
    # an empty document has no words to trade: a coin of its own decides it
    start = (units.join(small, F.col("source").eqNullSafe(F.col("s")))
                  .withColumn("ratio", ratio).withColumn("base", base)
                  .withColumn("p", F.when(F.col("words") > 0, fraction).otherwise(
                      (_uniform(-1, seed) < fraction).cast("double")))
                  .select(*_KEY, "words", "base", "p", leaf.alias("leaf")))
    step = _settle(start, 0, seed)
    done = [step.where("p = 0 or p = 1")]
    leaves = plan.agg(F.max(F.ceil(F.col("n_units") / F.lit(leaf_units)))).first()[0] or 0
    level = 0
    while leaves > 1:
        level, leaves = level + 1, -(-leaves // fan_in)
        open_units = step.where("p > 0 and p < 1").withColumn(
            "leaf", F.floor(F.col("leaf") / F.lit(fan_in)).cast("long"))
        step = _settle(open_units, level, seed)
        done.append(step.where("p = 0 or p = 1"))
    # one undecided document at most is left of each source: the nearer side
    done.append(step.where("p > 0 and p < 1").withColumn("p", F.round("p")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = out.select(*_KEY, (F.col("base") + F.col("p").cast("int")).alias("copies"))
    return (out.join(small, F.col("source").eqNullSafe(F.col("s")))
               .select(*_KEY, "source_size", "target", "copies"))


def mix_table(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target,
    copies, taken (words taken, repeats counted)."""
    slim = saved(sized(docs), "mix-sizes")
    c = copies(slim, **options)
    c = c.select(*[F.col(k).alias(f"c_{k}") for k in _KEY], "source_size", "target", "copies")
    same = [F.col(k).eqNullSafe(F.col(f"c_{k}")) for k in _KEY]
    return (slim.join(c, same).withColumn("taken", F.col("copies") * F.col("size"))
                .select(*_KEY, "source_size", "target", "copies", "taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as it is taken."""
    c = copies(docs.select("doc_id", "source", "text"), **options)
    c = c.where("copies > 0").select(*[F.col(k).alias(f"c_{k}") for k in _KEY], "copies")
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), word_count("text").alias("size"))
    same = [F.col(k).eqNullSafe(F.col(f"c_{k}")) for k in _KEY]
    return (rows.join(c, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
                .select("row.*"))
