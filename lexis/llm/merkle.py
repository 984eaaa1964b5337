"""Merkle manifest of a data set, with leaf positions by bitmap rank.

Rows are leaves. The leaves of a group (a source) form a tree in the order of
their ids, ``FAN_OUT`` nodes to a parent; the groups' roots, in the order of
the groups' names, form one more tree. ``manifest`` returns every row's leaf,
its group's root, the root of all, and its proof: for each level the texts of
the siblings left and right of it.

* **Positions without sorting the leaves.** A task turns its ids into words of
  64 bits per group; only words with a bit set are kept, and equal words of
  all tasks are merged by OR. A directory of popcounts (words within blocks of
  2^16 ids, blocks within the group) gives the rank of a word's first id, and
  a leaf finds its place by the popcount of the bits below its own. Words
  whose ids repeat also count each id (``_repeats``).
* **Keyed slots.** A leaf goes to slot ``rank % 256`` of chunk ``rank / 256`` of
  its group, which holds exactly two levels. Chunks reduce on their own, their
  tops are the next step's nodes, so a group of n leaves takes log256(n)
  steps, each 256 times smaller, and a hot group is as many chunks as others.
* **Proofs from the top.** A step's chunks learn the path above them from the
  step after it, one row per chunk; leaves are exploded from their chunks last.

Defined cases: a null field hashes as ``-``; a null group is a group, first in
order; null ids come first in their group; rows with the same id are ordered
by leaf digest (equal leaves are told apart by position alone); an empty table
gives no rows; other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node. A chunk holds two levels of them.
FAN_OUT = 16
CHUNK_BITS = 8
WORD_BITS = 6
BLOCK_BITS = 16
#: The word of null ids: below that of any 64-bit id.
NULL_WORD = -(1 << 59)


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated as UTF-8."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row's fields, each with its length in bytes before it."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                    for t in texts])


def fold(own: Column, path: Column) -> Column:
    """The root that ``own`` leads to along a proof."""
    return F.aggregate(path, own, lambda at, step: digest(step["left"], at, step["right"]))


def siblings(path: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _same(a: DataFrame, b: DataFrame, how: str, *keys: str) -> DataFrame:
    """Join on keys that may be null; the right side's keys are dropped."""
    b = b.withColumnsRenamed({k: f"{k}__" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"{k}__")) if k == "grp" else F.col(k) == F.col(f"{k}__") for k in keys]
    return a.join(b, on, how).drop(*[f"{k}__" for k in keys])


def _words(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, n, before, total): the merged bitmap of every group,
    with the rows of the group before the word and in all."""
    words = saved(rows.groupBy("grp", "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.count("*").alias("n")), "merkle-words")
    words = words.withColumn("block", F.shiftright("word", BLOCK_BITS - WORD_BITS))
    group, ahead = Window.partitionBy("grp"), (Window.unboundedPreceding, -1)
    blocks = words.groupBy("grp", "block").agg(F.sum("n").alias("n")).select(
        "grp", "block", F.coalesce(F.sum("n").over(group.orderBy("block").rowsBetween(*ahead)), F.lit(0)).alias("base"),
        F.sum("n").over(group).alias("total"))
    inside = Window.partitionBy("grp", "block").orderBy("word").rowsBetween(*ahead)
    words = words.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return saved(_same(words, blocks, "left", "grp", "block").select(
        "grp", "word", "bits", "n", (F.col("before") + F.col("base")).alias("before"), "total"), "merkle-directory")


def _repeats(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(grp, word, bit, leaf, part, skip): for words whose ids repeat, the
    rows of the word that come before those of (id, leaf) in one task's part.

    Repeated ids are ordered by leaf, then part. Nothing gathers the rows of
    one id: they are counted by (leaf, part), counts are summed in front of
    each other within 4 hex digits of the leaf, those sums within the id, and
    those within the word.
    """
    many = words.where(F.col("n") > F.bit_count("bits")).select("grp", "word")
    ident, ahead = ["grp", "word", "bit"], (Window.unboundedPreceding, -1)

    def earlier(keys: list[str], *order: str) -> Column:
        return F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*ahead)), F.lit(0))

    parts = saved(_same(rows, many, "left_semi", "grp", "word").groupBy(*ident, "leaf", "part")
                  .agg(F.count("*").alias("n")).withColumn("pre", F.substring("leaf", 1, 4)), "merkle-repeats")
    pres = parts.groupBy(*ident, "pre").agg(F.sum("n").alias("n"))
    bits = pres.groupBy(*ident).agg(F.sum("n").alias("n"))
    bits = bits.select(*ident, earlier(["grp", "word"], "bit").alias("a"))
    pres = pres.select(*ident, "pre", earlier(ident, "pre").alias("b"))
    parts = parts.select(*ident, "pre", "leaf", "part", earlier([*ident, "pre"], "leaf", "part").alias("c"))
    found = _same(_same(parts, pres, "inner", *ident, "pre"), bits, "inner", *ident)
    return saved(found.select(*ident, "leaf", "part", F.expr("a + b + c").alias("skip")), "merkle-skips")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, word, bit, leaf, part, x) with their position ``i`` in
    their group and the group's number of rows ``n``."""
    words = _words(rows)
    placed = _same(rows, words.withColumnsRenamed({"n": "in_word", "total": "n"}), "inner", "grp", "word")
    below = F.expr("before + bit_count(bits & ~shiftleft(-1L, bit))")
    once = F.col("in_word") == F.bit_count("bits")
    out = ["grp", "n", "i", "leaf", "x"]
    if words.where(F.col("n") > F.bit_count("bits")).isEmpty():
        return placed.withColumn("i", below).select(*out)
    skips = _repeats(rows, words)
    nth = F.row_number().over(Window.partitionBy("grp", "word", "bit", "leaf", "part").orderBy("leaf")) - 1
    again = _same(placed.where(~once), skips, "inner", "grp", "word", "bit", "leaf", "part")
    again = again.withColumn("i", F.col("before") + F.col("skip") + nth)
    return placed.where(once).withColumn("i", below).select(*out).unionByName(again.select(*out))


def _chunks(nodes: DataFrame, step: str) -> DataFrame:
    """(grp, n, chunk, slots, runs, top): the slot array of each 256 nodes of
    a group, the parents of its runs, and the one node they reduce to."""
    slot = F.struct((F.col("i") % (1 << CHUNK_BITS)).cast("int").alias("slot"), F.col("leaf").alias("own"), F.col("x"))
    c = (nodes.groupBy("grp", "n", F.shiftright("i", CHUNK_BITS).alias("chunk"))
              .agg(F.array_sort(F.collect_list(slot)).alias("slots")))
    last = F.expr(f"(size(slots) - 1) div {FAN_OUT}").cast("int")
    own = F.transform("slots", lambda s: s["own"])
    c = c.withColumn("own", own).withColumn("runs", F.transform(
        F.sequence(F.lit(0), last),
        lambda r: F.sha2(F.array_join(F.slice(F.col("own"), r * FAN_OUT + 1, F.lit(FAN_OUT)), ""), 256)))
    top = (F.when(F.col("n") == 1, F.col("own")[0]).when(F.col("n") <= FAN_OUT, F.col("runs")[0])
            .otherwise(F.sha2(F.array_join("runs", ""), 256)))
    return saved(c.withColumn("top", top).drop("own"), f"merkle-{step}")


def _steps(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Chunk tables of a forest of trees, from the leaves up; the last has one
    chunk for each group. ``most``: nodes of the largest group."""
    steps = []
    while True:
        steps.append(_chunks(nodes, f"{name}-{len(steps)}"))
        most = -(-most >> CHUNK_BITS)
        if most <= 1:
            return steps
        nodes = steps[-1].select(
            "grp", F.expr(f"(n + {(1 << CHUNK_BITS) - 1}) div {1 << CHUNK_BITS}").alias("n"),
            F.col("chunk").alias("i"), F.col("top").alias("leaf"), F.lit(None).cast("int").alias("x"))


def _below(chunks: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, i, own, x, path, tops): a chunk table's nodes with their paths;
    ``above`` has (grp, i, path, tops) for each chunk."""
    def step(nodes: str, at: str) -> Column:
        texts = F.col(nodes)
        return F.struct(F.array_join(F.slice(texts, F.lit(1), F.col(at)), "").alias("left"),
                        F.array_join(F.slice(texts, F.col(at) + 2, F.lit(FAN_OUT)), "").alias("right"))

    t = _same(chunks.withColumnRenamed("chunk", "i"), above, "inner", "grp", "i")
    t = t.select("grp", "n", "i", "path", "tops", "slots", "runs", F.posexplode("runs").alias("run", "parent"))
    t = t.select("grp", "n", "i", "run", "path", "tops", step("runs", "run").alias("upper"),
                 F.slice("slots", F.col("run") * FAN_OUT + 1, F.lit(FAN_OUT)).alias("slots"))
    t = t.select("*", F.transform("slots", lambda s: s["own"]).alias("owns"))
    t = t.select("*", F.posexplode("slots").alias("at", "s"))
    lower = step("owns", "at")
    path = (F.when(F.col("n") == 1, F.col("path"))
             .when(F.col("n") <= FAN_OUT, F.concat(F.array(lower), F.col("path")))
             .otherwise(F.concat(F.array(lower, F.col("upper")), F.col("path"))))
    return t.select("grp", (F.col("i") * (1 << CHUNK_BITS) + F.col("s.slot")).alias("i"), F.col("s.own").alias("own"),
                    F.col("s.x").alias("x"), path.alias("path"), "tops")


def _down(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    for chunks in reversed(steps):
        above = _below(chunks, above)
    return above


def _in_order(groups: DataFrame) -> tuple[DataFrame, int]:
    """``groups`` (grp, leaf) as nodes of one tree, in the order of ``grp``
    (null first, bytewise), and their number. Positions are those within a
    range partition plus the rows of the partitions before it."""
    dealt = saved(groups.repartitionByRange(F.col("grp").asc_nulls_first())
                        .withColumn("part", F.spark_partition_id()), "merkle-groups")
    counts = dealt.groupBy("part").agg(F.count("*").alias("k"))
    first = counts.select("part", F.coalesce(F.sum("k").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    n = dealt.count()
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("grp").asc_nulls_first())) - 1
    nodes = dealt.withColumn("own", own).join(first, "part").select(
        F.lit(0).alias("grp"), F.lit(n).cast("long").alias("n"), (F.col("first") + F.col("own")).alias("i"), "leaf",
        F.struct(F.col("grp").alias("name")).alias("x"))
    return nodes, n


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
             carry: Mapping[str, Column] | None = None) -> DataFrame:
    """(key, group, leaf, path, subroot, root, ...) for every row of ``docs``.

    ``path`` is the proof: an array of (left, right) sibling texts from the
    row's level up; ``fold(leaf, path)`` is ``root`` for an intact row.
    ``carry`` names further columns of ``docs`` expressions to return.
    """
    ident = F.col(f"`{key}`").cast("long")
    own = {"key": ident} | {f"c{k}": v for k, v in enumerate((carry or {}).values())}
    rows = docs.select(
        F.col(f"`{group}`").cast("string").alias("grp"),
        F.coalesce(F.shiftright(ident, WORD_BITS), F.lit(NULL_WORD)).alias("word"),
        F.coalesce(ident.bitwiseAND(F.lit((1 << WORD_BITS) - 1)), F.lit(0)).cast("int").alias("bit"),
        leaf([F.col(f"`{f}`") for f in fields]).alias("leaf"),
        F.struct(*[v.alias(k) for k, v in own.items()]).alias("x"),
        F.spark_partition_id().alias("part"))
    nodes = saved(ranked(saved(rows, "merkle-leaves")), "merkle-ranks")
    most = nodes.agg(F.max("n")).first()[0] or 0
    steps = _steps(nodes, most, "tree")
    tops, n = _in_order(steps[-1].select("grp", F.col("top").alias("leaf")))
    forest = _steps(tops, n, "forest")
    root = forest[-1].select(
        "grp", F.lit(0).cast("long").alias("i"), F.expr("cast(array() AS array<struct<left string, right string>>)").alias("path"),
        F.struct(F.col("top").alias("root")).alias("tops"))
    groups = _down(forest, root).select(
        F.col("x.name").alias("grp"), F.lit(0).cast("long").alias("i"), "path",
        F.struct(F.col("own").alias("subroot"), F.col("tops.root").alias("root")).alias("tops"))
    found = _down(steps, saved(groups, "merkle-tops"))
    return found.select(F.col("x.key").alias(key), F.col("grp").alias(group), F.col("own").alias("leaf"), "path",
                        F.col("tops.subroot").alias("subroot"), F.col("tops.root").alias("root"),
                        *[F.col(f"x.c{k}").alias(c) for k, c in enumerate(carry or {})])


def tampered_leaf() -> Column:
    """The leaf of a row with A-Z of its text lower-cased, where 5 divides the
    crc32 of the decimal doc_id; null for the other rows."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf([low if f == "text" else F.col(f) for f in FIELDS]))
