"""The manifest against one computed row by row with hashlib."""

import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from lexis.llm import merkle
from tests.llm.helpers import AWKWARD, DOC_COLS, awkward, clashing, empty, lower


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in
                     (row[0], row[3], row[2], row[4], row[1])))


def tree(nodes):
    """The root, and for each node its (left, right) texts up to the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            a = i // 16 * 16
            paths[k].append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + 16])))
        nodes, at = ["".join(nodes[a:a + 16]) for a in range(0, len(nodes), 16)], [i // 16 for i in at]
        nodes = [h(x) for x in nodes]
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own, tops = [], []
    for g in names:
        rs = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in rs])
        tops.append(top)
        own += [(r, g, p) for r, p in zip(rs, paths)]
    root, above = tree(tops)
    out = []
    for r, g, p in own:
        k = names.index(g)
        path = p + above[k]
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        at = leaf((r[0], lower(r[1]) if r[1] is not None else None, *r[2:])) if changed else leaf(r)
        for left, right in path:
            at = h(left + at + right)
        out.append((r[0], g, leaf(r), tops[k], root, h("".join(a + b for a, b in path)), at))
    return sorted(out, key=repr)


def found(df):
    m = merkle.manifest(df, carry={"changed": merkle.tampered_leaf()})
    m = m.select("doc_id", "source", "leaf", "subroot", "root",
                 F.sha2(merkle.siblings(F.col("path")), 256).alias("proof"),
                 merkle.fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded"),
                 (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("intact"))
    rows = m.collect()
    assert all(r.intact for r in rows)
    return sorted((tuple(r)[:-1] for r in rows), key=repr)


def test_awkward_rows(spark):
    assert found(awkward(spark)) == expected(AWKWARD)
    assert found(clashing(spark)) == expected(AWKWARD)
    assert found(empty(spark)) == []


def test_levels_groups_and_repeated_ids(spark):
    big = [(i * 37 - 9_000, f"Text {i}", "en", "big", i) for i in range(700)]           # three levels, negative ids
    big += [(5 * 37 - 9_000, f"Other {i}", "en", "big", None) for i in range(40)]       # an id 41 times
    big += [(None, "Same", "en", "big", 1)] * 30 + [(2**63 - 1, "Max", None, "big", 0), (-2**63, "Min", None, "big", 0)]
    some = [(i, "X", "en", "sixteen", 1) for i in range(16)] + [(i, "X", "en", "seventeen", 1) for i in range(17)]
    many = [(i, "y", "en", f"s{i:03d}é", 1) for i in range(300)] + [(7, None, None, None, None)]
    rows = big + some + many
    df = spark.createDataFrame(rows, DOC_COLS).repartition(7)
    assert found(df) == expected(rows)
