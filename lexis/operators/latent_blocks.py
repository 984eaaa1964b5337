"""The documents x words matrix in parts, and its products with a block of columns.

Documents are dealt to parts, as many as the cores, ``PART_ROWS`` or ``PART_DOCS`` ask
for, and words to groups. A part's entries are written once, bucketed by part, as tiles:
the entries of a run of documents and a group of words, sorted by word, with the word's
key, the place of the document and tf. Beside them stand the part's words: key, idf,
signs, and whether no other part has the word. Neither moves again. What moves in a step
is a row for each (part, word), once to the word and once back, and none for a word of
one part, whose row is made anew where it is used; documents' rows are written by part.

A task reads a part group by group (``_streamed``): it holds the rows of the part's
documents, and the tiles and words' rows of one group. Its memory follows ``PART_DOCS``
and the sizes of a group, not the part's words or entries. That is why parts can be large,
which keeps down the rows that move.

Words' rows move in bundles, one for each (part, group of words). A row is a power of
two and five bytes for each number (``coded``), off by at most 2**-38 of the row's
largest number. Sums and bases are doubles.

A word's key is a 64-bit hash under a seed for which no two words of the
dictionary meet (``word_keys`` checks it). A group is a range of keys.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions.scoring import vector_idf
from lexis.operators.batch import _starts
from lexis.operators.index import Index
from lexis.operators.lsa import R_SCHEMA, _add_rows, merge_tree

# Workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Postings and documents that a part is made for.
PART_ROWS = 64 << 20
PART_DOCS = 1 << 18
#: Postings that are sorted by document, and cut into tiles, at a time.
PACK_ROWS = 1 << 20
TILE_ROWS = 1 << 21
#: Rows that are turned into Python's objects at a time.
ROWS_READ = 1 << 10
#: A tile's documents are numbered by two bytes.
TILE_RUNS = 1 << 16
#: A group of words has at most about so many rows of (part, word), words, and
#: entries in a part.
GROUP_ROWS = 1 << 19
GROUP_WORDS = 1 << 16
GROUP_ENTRIES = 1 << 21
#: Documents of a row of a part's product.
CHUNK = 1 << 16

#: Kinds of rows: of ``Blocks.table``, of a product, words' sums on their way back, and
#: (of the table again) the documents that a cut's tiles number.
ENTRIES, WORDS, DOCS = 0, 1, 2
ROWS, OF_ROWS, OF_WORDS = 3, 4, 5
SUMS, RUNS = 6, 7
#: In place of a group: rows of the part's documents, which come first.
HEAD = -1

#: A bundle of rows of a part's words in order of their keys; ``ones`` marks a word
#: in one of its parts. A part knows its keys: going back, they are left out.
UP_SCHEMA = "group int, part int, keys binary, z binary"
DOWN_SCHEMA = "group int, part int, keys binary, ones binary, z binary"
#: ``data``: doubles of ``ROWS`` from place ``at`` on, or a triangular factor.
PRODUCT_SCHEMA = "part int, kind int, at long, width int, data binary"


@dataclass
class Blocks:
    """``table``: the rows of all parts, bucketed by part; ``parts`` their numbers,
    ``groups`` those of the groups of words; ``dictionary`` (key, term, idf, _s0..)."""
    table: DataFrame
    parts: list[int]
    groups: list[int]
    dictionary: DataFrame
    doc_type: T.DataType


# --- writing -------------------------------------------------------------------

def part_numbers(spark: SparkSession, n: int) -> list[int]:
    """One number for each of n buckets, which the bucketing's hash deals to it:
    0..n-1 would leave buckets empty and others with several parts."""
    found: dict[int, int] = {}
    at = 0
    while len(found) < n:
        ids = spark.range(at, at + 16 * n).select(F.col("id").cast("int").alias("part"))
        for r in ids.groupBy(F.pmod(F.hash("part"), F.lit(n)).alias("b")).agg(F.min("part").alias("part")).collect():
            found.setdefault(r.b, r.part)
        at += 16 * n
    return [found[b] for b in range(n)]


def word_keys(terms: DataFrame) -> Column:
    """A hash of ``term`` by which no two words of ``terms`` meet."""
    for seed in range(64):
        key = F.xxhash64("term", F.lit(seed))
        if not terms.groupBy(key.alias("key")).count().where("count > 1").head(1):
            return key
    raise ValueError("words repeat in the dictionary")


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _packed(batches: Iterator[pa.RecordBatch]):
    """(doc_id, n_tokens, key, tf) row by row -> a row for each document of many rows."""
    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        t = t.take(pc.sort_indices(t, [(t.column_names[0], "ascending"), (t.column_names[1], "ascending")])).combine_chunks()
        doc, (n, keys, tf) = t.column(0).chunk(0), (t.column(i).to_numpy() for i in (1, 2, 3))
        n, keys, tf = n.astype("<i8"), keys.astype("<i8"), tf.astype("<i4")
        starts = np.union1d(_starts(doc), np.flatnonzero(np.diff(n)) + 1).astype(np.int64)
        spans = list(zip(starts, np.r_[starts[1:], len(n)]))
        return pa.RecordBatch.from_arrays(
            [doc.take(pa.array(starts)), pa.array(n[starts]), _binary([keys[x:y] for x, y in spans]),
             _binary([tf[x:y] for x, y in spans])], names=["doc_id", "n_tokens", "keys", "tfs"])

    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= PACK_ROWS:
            yield pack(held)
            held, rows = [], 0
    if held:
        yield pack(held)


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype("<u2") if not len(x) or x.max() < 1 << 16 else x.astype("<i4")


def _whole(raw, n: int) -> np.ndarray:
    """What ``_small`` made of n numbers."""
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<i4")


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    """Places of the keys' groups: equal ranges of keys, in order."""
    return ((keys >> 33) + (1 << 30)) * groups >> 31


_COLUMNS = {"part": T.IntegerType(), "group": T.IntegerType(), "kind": T.IntegerType(), "at": T.LongType(), "docs": None,
            **{c: T.BinaryType() for c in ("n", "keys", "counts", "places", "tfs", "idf", "signs", "local")}}


def _schema(doc_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, t or T.ArrayType(doc_type)) for c, t in _COLUMNS.items()])


def _rows(doc_type: pa.DataType, rows: list[dict]) -> pa.RecordBatch:
    """Rows of ``Blocks.table``; columns that a row lacks are null."""
    kinds = {"docs": pa.list_(doc_type), "at": pa.int64(), "part": pa.int32(), "group": pa.int32(), "kind": pa.int32()}
    cell = lambda v: v.tobytes() if isinstance(v, np.ndarray) else v
    return pa.RecordBatch.from_arrays(
        [pa.array([cell(r.get(c)) for r in rows], kinds.get(c, pa.binary())) for c in _COLUMNS], names=list(_COLUMNS))


def _tiles(doc_type: pa.DataType, groups: list[int]):
    """Documents' postings -> tiles of their part, cut by cut (``at``), with the cut's documents,
    and the part's: the distinct ones in order (null last; ``at`` of them are none), and for
    each (document, length) its place there and its length. Cuts number the latter."""
    def cut(part: int, at: int, runs: list) -> list[dict]:
        keys, tf = (np.concatenate([np.frombuffer(r[i], t) for r in runs]) for i, t in ((1, "<i8"), (2, "<i4")))
        found, places = np.unique([r[0] for r in runs], return_inverse=True)
        place = np.repeat(places.astype("<u2"), [len(r[1]) // 8 for r in runs])
        order = np.argsort(keys, kind="stable")
        keys, tf, place = keys[order], tf[order], place[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        words, ends = keys[starts], np.r_[starts, len(keys)]
        counts, cuts = np.diff(ends), np.searchsorted(_group(words, len(groups)), np.arange(len(groups) + 1))
        tiles = [{"part": part, "group": g, "kind": ENTRIES, "at": at, "keys": words[x:y], "counts": _small(counts[x:y]),
                  "places": place[ends[x]:ends[y]], "tfs": _small(tf[ends[x]:ends[y]])}
                 for g, x, y in zip(groups, cuts[:-1], cuts[1:]) if x < y]
        return [{"part": part, "group": HEAD, "kind": RUNS, "at": at, "places": found.astype("<i4")}, *tiles]

    def documents(part: int, known: dict) -> dict:
        of = pa.array([doc for doc, _ in known], doc_type)
        found = _distinct(of)
        return {"part": part, "group": HEAD, "kind": DOCS, "at": len(found) - found.null_count, "docs": found.to_pylist(),
                "places": pc.index_in(of, value_set=found).to_numpy().astype("<i4"),
                "n": np.array([n for _, n in known], "<f8")}

    def run(batches):
        held, rows, cuts, known = {}, {}, {}, {}
        few = (b.slice(at, ROWS_READ) for b in batches for at in range(0, b.num_rows, ROWS_READ))
        for b in few:
            for part, doc, n, *r in zip(*[b.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "keys", "tfs")]):
                mine, places = held.setdefault(part, []), known.setdefault(part, {})
                mine.append((places.setdefault((doc, n), len(places)), *r))
                rows[part] = rows.get(part, 0) + len(r[0]) // 8
                if rows[part] >= TILE_ROWS or len(mine) == TILE_RUNS:
                    yield _rows(doc_type, cut(part, cuts.setdefault(part, 0), held.pop(part)))
                    cuts[part], rows[part] = cuts[part] + 1, 0
        for part in known:
            last = cut(part, cuts.get(part, 0), held[part]) if part in held else []
            yield _rows(doc_type, [*last, documents(part, known[part])])
    return run


def _distinct(docs: pa.Array) -> pa.Array:
    """Distinct documents in order, null last."""
    found = pc.unique(docs)
    return found.take(pc.sort_indices(found))


def _group_words(table: pa.Table) -> pa.Table:
    """The distinct words of a part's tiles of one group."""
    keys = np.unique(np.concatenate([np.frombuffer(k.as_buffer(), "<i8") for k in table.column("keys")]))
    both = [pa.array(np.full(len(keys), table.column(c)[0].as_py(), np.int32)) for c in ("part", "group")]
    return pa.table([*both, pa.array(keys)], names=["part", "group", "key"])


def _word_rows(doc_type: pa.DataType, signs: int):
    """(part, group, key, parts, idf, _s0..) in order of part and group -> rows of many words."""
    def run(batches):
        for b in batches:
            part, group, key, parts, idf, *bits = (b.column(c).to_numpy() for c in range(5 + signs))
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(group) != 0)) + 1
            spans = zip(np.r_[0, cuts], np.r_[cuts, len(part)]) if len(part) else ()
            rows = [{"part": int(part[x]), "group": int(group[x]), "kind": WORDS, "keys": key[x:y].astype("<i8"),
                     "idf": idf[x:y].astype("<f8"), "local": parts[x:y] == 1,
                     "signs": np.stack([s[x:y] for s in bits], axis=1).astype("<i8")} for x, y in spans]
            yield _rows(doc_type, rows)
    return run


def _append(df: DataFrame, n: int, name: str, path: str) -> None:
    df.write.mode("append").format("parquet").bucketBy(n, "part").option("path", path).saveAsTable(name)


def kept(blocks: Blocks, product: DataFrame, name: str, path: str) -> DataFrame:
    """A product written under ``path`` as the table ``name``, by part like the blocks:
    reading it with them needs no exchange."""
    _append(product, len(blocks.parts), name, path)
    return product.sparkSession.table(name)


def store_blocks(index: Index, path: str, name: str, signs: list[Column], words_max: int) -> Blocks:
    """Write the blocks of ``index`` under ``path`` as the table ``name``. A dictionary
    of at most ``words_max`` words is broadcast to the parts' words."""
    spark, doc_type = index.sparkSession, index.postings.schema["doc_id"].dataType
    corpus, n_words = index.corpus.select("n_postings", "n_docs").first() or (0, 0), index.terms.count()
    n = max(spark.sparkContext.defaultParallelism, -(-corpus[0] // PART_ROWS), -(-corpus[1] // PART_DOCS))
    parts, key = part_numbers(spark, n), word_keys(index.terms)
    groups = part_numbers(spark, max(n, -(-min(n * n_words, corpus[0]) // GROUP_ROWS), -(-n_words // GROUP_WORDS),
                                     -(-corpus[0] // (n * GROUP_ENTRIES))))
    number = F.element_at(F.array(*[F.lit(p) for p in parts]), (F.pmod(F.xxhash64("doc_id"), F.lit(n)) + 1).cast("int"))
    runs = index.postings.select("doc_id", "n_tokens", key.alias("key"), "tf").mapInArrow(_packed, T.StructType([
        T.StructField("doc_id", doc_type), T.StructField("n_tokens", T.LongType()),
        T.StructField("keys", T.BinaryType()), T.StructField("tfs", T.BinaryType())]))
    schema, arrow = _schema(doc_type), pa.int64()
    if not isinstance(doc_type, T.LongType):
        from pyspark.sql.pandas.types import to_arrow_type
        arrow = to_arrow_type(doc_type)
    _append(runs.withColumn("part", number).repartition(n, "part").mapInArrow(_tiles(arrow, groups), schema), n, name, path)
    dictionary = (index.terms.crossJoin(F.broadcast(index.corpus.select("n_docs")))
                  .select(key.alias("key"), "term", vector_idf(F.col("df"), F.col("n_docs")).alias("idf"), *signs))
    held = (spark.table(name).where(F.col("kind") == ENTRIES).select("part", "group", "keys").groupBy("part", "group")
                 .applyInArrow(_group_words, "part int, group int, key long"))
    held = held.withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy("key")))
    words = held.join(F.broadcast(dictionary) if n_words <= words_max else dictionary, "key")
    words = words.select("part", "group", "key", "parts", "idf", *[f"_s{d}" for d in range(len(signs))])
    _append(words.repartition(n, "part").sortWithinPartitions("part", "group")
                 .mapInArrow(_word_rows(arrow, len(signs)), schema), n, name, path)
    spark.catalog.refreshTable(name)
    return Blocks(spark.table(name), parts, groups, dictionary, doc_type)


# --- rows that move --------------------------------------------------------------

def coded(z: np.ndarray) -> np.ndarray:
    """Rows as bytes: an exponent, and five bytes for each number."""
    n, width = z.shape
    e = np.frexp(np.abs(z).max(axis=1, initial=0.0))[1]
    whole = np.clip(np.rint(np.ldexp(z, 39 - e[:, None])), -(1 << 39), (1 << 39) - 1).astype("<i8")
    out = np.empty((n, 2 + 5 * width), np.uint8)
    out[:, :2] = e.astype("<i2").reshape(-1, 1).view(np.uint8)
    out[:, 2:] = whole.view(np.uint8).reshape(n, width, 8)[:, :, :5].reshape(n, 5 * width)
    return out


def decoded(raw, width: int) -> np.ndarray:
    raw = np.frombuffer(raw, np.uint8).reshape(-1, 2 + 5 * width)
    e = np.ascontiguousarray(raw[:, :2]).view("<i2").astype(np.int64)
    wide = np.zeros((len(raw), width, 8), np.uint8)
    wide[:, :, 3:] = raw[:, 2:].reshape(len(raw), width, 5)
    return np.ldexp((wide.view("<i8")[:, :, 0] >> 24).astype(float), e - 39)


# --- a part, group by group --------------------------------------------------------

def _streamed(frames: list[DataFrame], n: int, run: Callable, schema: str) -> DataFrame:
    """``run`` over each part's rows of all frames, by group. Tables by part stay where
    they are: renamed, their column is one that the planner knows in a union as well."""
    frames = [f.withColumnRenamed("part", "dealt").repartition(n, "dealt") for f in frames]
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.repartition(n, "dealt").sortWithinPartitions("dealt", "group").groupBy("dealt").applyInArrow(run, schema)


def _matrix(blocks: Blocks, *without: str) -> DataFrame:
    return blocks.table.drop("docs", *without)


def _rows_in(y: DataFrame) -> DataFrame:
    """A product's documents' rows, as ``_streamed`` takes them."""
    return y.where(F.col("kind") == ROWS).select("part", F.lit(HEAD).alias("group"), "kind", "at", "width", "data")


class _Row:
    """One row of a batch, cell by cell."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.batch, self.i = batch, i
        self.kind = batch.column("kind")[i].as_py()

    def number(self, column: str) -> int:
        return self.batch.column(column)[self.i].as_py()

    def raw(self, column: str):
        return self.batch.column(column)[self.i].as_buffer()

    def cells(self, column: str, kind: str) -> np.ndarray:
        return np.frombuffer(self.raw(column), kind)


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[_Row]]]:
    """(group, its rows), ``HEAD`` first. A part's rows must come by group."""
    now, rows, seen = None, [], set()
    for b in batches:
        group = b.column("group").to_numpy()
        cuts = np.flatnonzero(np.diff(group)) + 1
        for x, y in zip(np.r_[0, cuts], np.r_[cuts, len(group)]) if len(group) else ():
            if group[x] != now:
                if rows:
                    yield now, rows
                now, rows = int(group[x]), []
                if now in seen:
                    raise ValueError("a part's rows are not in order of their groups")
                seen.add(now)
            own = b.take(pa.array(np.arange(x, y)))     # a copy: the batch, of many groups, need not stay
            rows += [_Row(own, i) for i in range(len(own))]
    if rows:
        yield now, rows


class _Part:
    """A part's documents, from its ``HEAD`` rows, and what its entries add to them."""

    def __init__(self, rows: list[_Row]):
        doc = next(r for r in rows if r.kind == DOCS)
        self.number, self.filled = doc.number("dealt"), doc.number("at")
        self.doc, self.n = doc.cells("places", "<i4"), doc.cells("n", "<f8")
        self.n_docs = int(self.doc.max()) + 1
        self.cuts = {r.number("at"): r.cells("places", "<i4") for r in rows if r.kind == RUNS}
        found = sorted((r for r in rows if r.kind == ROWS), key=lambda r: r.number("at"))
        self.y = np.vstack([r.cells("data", "<f8").reshape(-1, r.number("width")) for r in found]) if found else None
        self.sums: np.ndarray | None = None

    def shares(self, m: np.ndarray) -> np.ndarray:
        """By (document, length): what an occurrence adds to a word's row, the document's
        row times ``m``. A null is no document that a word's row could be joined to."""
        y = self.y @ m
        y[self.filled:] = 0.0
        return y[self.doc] / self.n[:, None]

    def add(self, group: _Group, q: np.ndarray) -> None:
        """Add the group's entries times ``q``, which has a row for each of its words."""
        if self.sums is None:
            self.sums = np.zeros((len(self.n), q.shape[1]))
        q = q * group.idf[:, None]
        for cut, at, _, counts, places, tf in group.each():
            of = self.cuts[cut]
            for c, x in enumerate(np.ascontiguousarray(q[at].T)):
                self.sums[of, c] += np.bincount(places, weights=np.repeat(x, counts) * tf, minlength=len(of))

    def product(self, width: int) -> np.ndarray:
        """The documents' rows."""
        out = np.zeros((self.n_docs, width))
        if self.sums is not None:
            np.add.at(out, self.doc, self.sums / self.n[:, None])
        return out


class _Group:
    """A part's words of one group, in order of their keys, and their tiles."""

    def __init__(self, rows: list[_Row]):
        words = [r for r in rows if r.kind == WORDS]
        cells = lambda c, t: np.concatenate([np.zeros(0, t), *[r.cells(c, t) for r in words]])
        keys = cells("keys", "<i8")
        self.order = np.argsort(keys)
        self.keys, self.idf, self.local = (x[self.order] for x in (keys, cells("idf", "<f8"), cells("local", "?")))
        self.words, self.tiles = words, [r for r in rows if r.kind == ENTRIES]
        self.back = [r for r in rows if r.kind == SUMS]

    def signs(self) -> np.ndarray:
        found = np.concatenate([np.zeros(0, "<i8"), *[r.cells("signs", "<i8") for r in self.words]])
        return found.reshape(len(self.keys), -1)[self.order]

    def each(self, chosen: np.ndarray | None = None):
        """(the cut, places of the words, where each word's entries start, counts, the entries'
        places in the cut, tf), by tile; of the ``chosen`` words alone if given."""
        for r in self.tiles:
            keys, places = r.cells("keys", "<i8"), r.cells("places", "<u2")
            counts, tf = _whole(r.raw("counts"), len(keys)).astype(int), _whole(r.raw("tfs"), len(places))
            at = np.searchsorted(self.keys, keys)
            if chosen is not None:
                own = chosen[at]
                entries = np.repeat(own, counts)
                at, counts, places, tf = at[own], counts[own], places[entries], tf[entries]
            if len(at):
                yield r.number("at"), at, np.r_[0, np.cumsum(counts)[:-1]], counts, places, tf.astype(float)

    def rows(self, part: _Part, shares: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
        """The words' rows: the entries, turned, times the documents' ``shares``."""
        out = np.zeros((len(self.keys), shares.shape[1]))
        for cut, at, starts, _, places, tf in self.each(chosen):
            out[at] += np.add.reduceat(shares[part.cuts[cut][places]] * tf[:, None], starts)
        return out * self.idf[:, None]


def _triangle(m: np.ndarray) -> np.ndarray:
    acc: dict[int, np.ndarray] = {}
    for at in range(0, len(m), CHUNK):
        _add_rows(acc, 0, m[at:at + CHUNK])
    return acc.get(0, np.zeros((0, m.shape[1])))


def _product_rows(part: int, y: np.ndarray, z: np.ndarray | None) -> pa.RecordBatch:
    """Rows of ``PRODUCT_SCHEMA``: the part's documents, and the factors of them and (``z``)
    of the words' rows that are counted here."""
    rows = [(ROWS, at, y[at:at + CHUNK]) for at in range(0, len(y), CHUNK)] + [(OF_ROWS, 0, _triangle(y))]
    rows += [(OF_WORDS, 0, z)] if z is not None else []
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()),
         pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].shape[1] for r in rows], pa.int32()),
         _binary([np.ascontiguousarray(r[2], "<f8") for r in rows])], names=["part", "kind", "at", "width", "data"])


def _rows_of(product: pa.Table) -> np.ndarray:
    """A part's documents' rows, put together in order."""
    return np.vstack([np.frombuffer(r["data"], "<f8").reshape(-1, r["width"])
                      for r in sorted(product.to_pylist(), key=lambda r: r["at"])])


# --- products --------------------------------------------------------------------

def signed(blocks: Blocks, columns: int, digits: int) -> DataFrame:
    """The matrix times the words' signs (bit c % digits of number c // digits is set for -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for number, rows in _by_group(batches):
            if number == HEAD:
                part = _Part(rows)
                continue
            group = _Group(rows)
            bits = group.signs()
            part.add(group, np.stack([1.0 - 2.0 * (bits[:, c // digits] >> (c % digits) & 1) for c in range(columns)], axis=1))
        if part is not None:
            yield _product_rows(part.number, part.product(columns), None)
    return _streamed([_matrix(blocks)], len(blocks.parts), run, PRODUCT_SCHEMA)


def words_of(blocks: Blocks, y: DataFrame, m: np.ndarray, keyed: bool = False) -> DataFrame:
    """``DOWN_SCHEMA``: the turned matrix times (``y`` times ``m``), a word's whole row for
    each part that has the word. Words of one part are left to ``documents_of``, unless
    the rows are to be ``keyed``."""
    width = m.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = part = None
        for number, rows in _by_group(batches):
            if number == HEAD:
                part = _Part(rows)
                shares, part.y = None if part.y is None else part.shares(m), None
                continue
            group = _Group(rows)
            sent = np.ones(len(group.keys), bool) if keyed else ~group.local
            if shares is not None and sent.any():
                z = coded(group.rows(part, shares, None if sent.all() else sent)[sent])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([part.number], pa.int32()), _binary([group.keys[sent]]),
                     _binary([z])], names=["group", "part", "keys", "z"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*[b.column(c) for c in ("group", "part", "keys", "z")])]
        each = [np.frombuffer(keys.as_buffer(), "<i8") for *_, keys, _ in rows]
        words = np.unique(np.concatenate(each))
        sums, new = np.zeros((len(words), width)), np.ones(len(words), bool)
        for keys, (*_, z) in zip(each, rows):
            sums[np.searchsorted(words, keys)] += decoded(z.as_buffer(), width)
        sums = coded(sums)
        for keys, (group, part, *_) in zip(each, rows):
            at = np.searchsorted(words, keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([group.as_py()], pa.int32()), pa.array([part.as_py()], pa.int32()),
                 _binary([keys]) if keyed else pa.nulls(1, pa.binary()), _binary([new[at]]), _binary([sums[at]])],
                names=["group", "part", "keys", "ones", "z"])
            new[at] = False
    up = _streamed([_rows_in(y), _matrix(blocks, "signs")], len(blocks.parts), run, UP_SCHEMA)
    return up.repartition(len(blocks.groups), "group").groupBy("group").applyInArrow(total, DOWN_SCHEMA)


def documents_of(blocks: Blocks, down: DataFrame, width: int, y: DataFrame | None = None,
                 m: np.ndarray | None = None) -> DataFrame:
    """``PRODUCT_SCHEMA``: the matrix times the rows of ``down``, and its factors. With ``y``
    and ``m``, the rows of words of one part are made here as ``words_of`` would make them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = shares = None
        counted: dict[int, np.ndarray] = {}
        for number, rows in _by_group(batches):
            if number == HEAD:
                part = _Part(rows)
                shares, part.y = None if part.y is None else part.shares(m), None
                continue
            group = _Group(rows)
            own = group.local if m is not None else np.zeros(len(group.keys), bool)
            q, one = np.zeros((len(group.keys), width)), own.copy()
            for r in group.back:
                q[~own], one[~own] = decoded(r.raw("z"), width), r.cells("ones", "?")
            if shares is not None and own.any():
                q[own] = group.rows(part, shares, own)[own]
            part.add(group, q)
            if one.any():
                _add_rows(counted, 0, q[one])
        if part is not None:
            yield _product_rows(part.number, part.product(width), counted.get(0, np.zeros((0, width))))
    sums = down.select("part", "group", F.lit(SUMS).alias("kind"), "ones", "z")
    frames = [_matrix(blocks, "signs"), sums, *([_rows_in(y)] if y is not None else [])]
    return _streamed(frames, len(blocks.parts), run, PRODUCT_SCHEMA)


def factor(blocks: Blocks, product: DataFrame, kind: int, width: int) -> np.ndarray:
    """A matrix of ``width`` columns with the singular values and right vectors of
    all documents' rows (``OF_ROWS``) or all words' rows (``OF_WORDS``)."""
    place = F.create_map(*[F.lit(x) for i, p in enumerate(blocks.parts) for x in (p, i)])
    r = product.where(F.col("kind") == kind).select(
        F.lit(0).cast("long").alias("query_id"), place[F.col("part")].alias("node"), F.col("width").alias("t"),
        F.col("data").alias("r"))
    found = merge_tree(r.select(*[f.split()[0] for f in R_SCHEMA.split(", ")]), tasks=len(blocks.parts)).collect()
    return np.vstack([np.zeros((0, width)), *[np.frombuffer(f.r, "<f8").reshape(-1, width) for f in found]])


def word_table(blocks: Blocks, down: DataFrame, m: np.ndarray, prefix: str) -> DataFrame:
    """(term, prefix0..): words' rows, with their keys, times ``m``."""
    names = [f"{prefix}{c}" for c in range(m.shape[1])]

    def run(batches):
        for b in batches:
            for keys, ones, z in zip(*b.columns):
                one = np.frombuffer(ones.as_buffer(), bool)
                x = decoded(z.as_buffer(), m.shape[0])[one] @ m
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(keys.as_buffer(), "<i8")[one]), *[pa.array(x[:, c]) for c in range(len(names))]],
                    names=["key", *names])
    rows = down.select("keys", "ones", "z").mapInArrow(run, ", ".join(["key long", *[f"{c} double" for c in names]]))
    return rows.join(blocks.dictionary.select("key", "term"), "key").select("term", *names)


def document_table(blocks: Blocks, product: DataFrame, m: np.ndarray, prefix: str) -> DataFrame:
    """(doc_id, prefix0..): documents' rows times ``m``."""
    names = [f"{prefix}{c}" for c in range(m.shape[1])]

    def run(table: pa.Table, rows: pa.Table) -> pa.Table:
        docs = pc.list_flatten(table.column("docs"))
        x = _rows_of(rows) @ m if rows.num_rows and len(docs) else np.zeros((len(docs), m.shape[1]))
        return pa.table([docs, *[pa.array(x[:, c]) for c in range(len(names))]], names=["doc_id", *names])
    docs = blocks.table.where(F.col("kind") == DOCS).select("part", "docs")
    schema = T.StructType([T.StructField("doc_id", blocks.doc_type), *[T.StructField(c, T.DoubleType()) for c in names]])
    return docs.groupBy("part").cogroup(product.where(F.col("kind") == ROWS).groupBy("part")).applyInArrow(run, schema)
