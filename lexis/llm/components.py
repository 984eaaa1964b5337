"""Connected components of an edge table, by alternating stars.

Every round links each node to the smallest node among its larger (large
star), then its smaller (small star) neighbours, until nothing changes. Only
minima are aggregated, so a node with a third of all edges is no hot group;
each round is saved in the shared folder.

Defined cases: no edges give no rows; loops and repeated edges change nothing;
rows with a null end are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import saved


def _fingerprint(edges: DataFrame):
    h = F.xxhash64("u", "v")
    return edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b long); the root is the
    component's smallest node."""
    big, small = F.greatest("a", "b"), F.least("a", "b")
    e = saved(edges.where("a <> b").select(big.alias("u"), small.alias("v")).distinct(), "cc-edges")
    seen = _fingerprint(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour points at the node's minimum
        large = (both.join(least, "u").where("v > u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        # small star: the node and its smaller neighbours point at the minimum
        stars = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(least.select("u", F.col("m").alias("v"))))
        e = saved(stars.distinct(), "cc-round")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
