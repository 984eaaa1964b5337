"""Quality classifier: random-indexing word vectors and a small network.

1. *Random indexing.* Every word has a sparse random index vector; its context
   vector is the sum of its neighbours' index vectors over the whole corpus.
   Words are hashed to a fixed number of buckets, so the table of context
   vectors has a fixed size (``TABLE_BYTES``) whatever the corpus. A word is
   read twice: by its letters and digits, and by its shape (``Ndrein$$$`` is
   ``Aa$$$``); the two have buckets of their own.
2. *Pooling.* A document is the mean vector of its words, and of its shapes.
3. *Network.* Two layers in numpy, fitted on the driver on at most
   ``MAX_TRAIN`` labelled documents (those with the smallest hash of their
   id); the logits are divided by a temperature fitted on a part of the sample
   that the network did not see.

Corpus statistics cover every row; the sample bounds only the fit. Sums are of
integers, so neither partitions nor retries change a vector.

Defined cases: null and wordless texts pool to the zero vector and get a
score like any other; rows with a null doc_id are scored, never trained on; a
document with differing labels counts as low quality; null labels are left
out; with no labels of one of the two classes every score is the share of
label 1 (0.5 if none); an empty table gives an empty result; columns other
than text and doc_id take no part in a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import shuffle_partitions, text_slices

WORDS, SHAPES, DIM = 8192, 1024, 64
BUCKETS = WORDS + SHAPES
PAD = BUCKETS                      # between documents; has no index vector
NONZERO, WINDOW, SHAPE_WINDOW = 2, 2, 1
TABLE_BYTES = BUCKETS * DIM * 8
CHUNK = 128                        # buckets in a row of the shuffled sums
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 30, 256, 3e-3, 1e-4
CALIBRATION = 0.2
THRESHOLD = 0.3
FOLDS = 5
SEED = 7


# --- words ------------------------------------------------------------------

def _hashed(words: pa.Array, buckets: int, first: int) -> np.ndarray:
    return np.fromiter((first + zlib.crc32(w.encode()) % buckets for w in words.to_pylist()),
                       np.int64, len(words))


def buckets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket and shape bucket of every word, and words in each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    lo, hi = split.offsets[0].as_py(), split.offsets[-1].as_py()
    coded = split.values.slice(lo, hi - lo).dictionary_encode()
    words = coded.dictionary
    body = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{N}]+", "").dictionary_encode()
    shape = words
    for pattern, mark in ((r"\p{N}+", "0"), (r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]+", "a")):
        shape = pc.replace_substring_regex(shape, pattern, mark)
    shape = pc.utf8_slice_codeunits(shape, 0, 12).dictionary_encode()
    which = coded.indices.to_numpy()
    of_body = _hashed(body.dictionary, WORDS, 0)[body.indices.to_numpy()]
    of_shape = _hashed(shape.dictionary, SHAPES, WORDS)[shape.indices.to_numpy()]
    return of_body[which], of_shape[which], np.diff(split.offsets.to_numpy())


def index_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero components of every bucket's index
    vector; the pad's signs are zero."""
    rng = np.random.default_rng(seed)
    place = rng.integers(0, DIM, (BUCKETS + 1, NONZERO))
    sign = rng.choice([-1.0, 1.0], (BUCKETS + 1, NONZERO))
    sign[PAD] = 0
    return place, sign


def add_contexts(table: np.ndarray, seq: np.ndarray, window: int, place, sign) -> None:
    """Add to ``table`` the index vectors of every word's neighbours."""
    for step in range(1, window + 1):
        a, b = seq[:-step], seq[step:]
        for word, other in ((a, b), (b, a)):
            for j in range(NONZERO):
                table += np.bincount(word * DIM + place[other, j], sign[other, j],
                                     minlength=table.size)[:table.size]


def _padded(seq: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    return np.insert(seq, np.repeat(np.cumsum(sizes), window), PAD)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Context sums of one task, in chunks of buckets."""
    place, sign = index_vectors()
    table = np.zeros((BUCKETS + 1) * DIM)
    for batch in batches:
        for part in text_slices(batch, "text"):
            body, shape, sizes = buckets_of(part.column("text"))
            add_contexts(table, _padded(body, sizes, WINDOW), WINDOW, place, sign)
            add_contexts(table, _padded(shape, sizes, SHAPE_WINDOW), SHAPE_WINDOW, place, sign)
    yield from _chunks(enumerate(table[:BUCKETS * DIM].reshape(-1, CHUNK * DIM)))


def _chunks(sums) -> Iterator[pa.RecordBatch]:
    for k, x in sums:
        if x.any():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()),
                                              "sums": [x.astype("<i8").tobytes()]})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of each chunk over a stream of task sums."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
            x = np.frombuffer(raw, "<i8")
            total[k] = total[k] + x if k in total else x
    yield from _chunks(total.items())


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all buckets, over every text of ``docs``.

    Each task sends its own sums (``TABLE_BYTES`` at most), which are added
    up in two steps: many partial sums by (chunk, salt), then by chunk.
    """
    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _contexts, "chunk int, sums binary")
    n = shuffle_partitions(docs.sparkSession)
    sums = sums.withColumn("salt", F.spark_partition_id() % n)
    sums = sums.repartition(n, "chunk", "salt").select("chunk", "sums").mapInArrow(
        _added, "chunk int, sums binary")
    sums = sums.repartition(n, "chunk").mapInArrow(_added, "chunk int, sums binary")
    table = np.zeros((BUCKETS // CHUNK, CHUNK * DIM))
    for row in sums.toLocalIterator():                 # BUCKETS / CHUNK rows
        table[row["chunk"]] += np.frombuffer(row["sums"], "<i8")
    table = table.reshape(BUCKETS, DIM)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norm == 0, 1, norm)).astype(np.float32)


def pool(table: np.ndarray, seq: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean table row over each document's words (zero for none)."""
    out = np.zeros((len(sizes), table.shape[1]), np.float32)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        step = 1 << 18                                 # words gathered at a time
        ends = starts + sizes[some]
        for d, a, b in zip(some, starts, ends) if (ends - starts).max() > step else ():
            out[d] = sum(table[seq[i:min(i + step, b)]].sum(0) for i in range(a, b, step))
        if (ends - starts).max() <= step:
            at = 0
            while at < len(some):
                upto = max(at + 1, int(np.searchsorted(ends, starts[at] + step, side="right")))
                rows = table[seq[starts[at]:ends[upto - 1]]]
                out[some[at:upto]] = np.add.reduceat(rows, starts[at:upto] - starts[at], axis=0)
                at = upto
        out[some] /= sizes[some][:, None]
    return out


# --- the network ------------------------------------------------------------

@dataclass
class Model:
    """Everything a task needs to score: per-bucket rows of the first layer
    (already standardised), the second layer and the temperature."""
    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    offset: float
    temperature: float

    def score(self, texts: pa.Array) -> np.ndarray:
        body, shape, sizes = buckets_of(texts)
        hidden = pool(self.first, body, sizes) + pool(self.first, shape, sizes) + self.bias
        return _sigmoid((np.maximum(hidden, 0) @ self.second + self.offset) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = SEED):
    """Weights (w1, b1, w2, b2) of a two-layer network, by Adam on the mean
    logistic loss."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            xb, yb = x[order[at:at + BATCH]], y[order[at:at + BATCH]]
            w1, b1, w2, b2 = params
            pre = xb @ w1 + b1
            act = np.maximum(pre, 0)
            err = (_sigmoid(act @ w2 + b2) - yb) / len(xb)
            back = np.outer(err, w2) * (pre > 0)
            grads = [xb.T @ back + DECAY * w1, back.sum(0), act.T @ err + DECAY * w2,
                     err.sum(keepdims=True)]
            t += 1
            for p, g, mi, vi in zip(params, grads, m, v):
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                p -= RATE * (mi / (1 - 0.9 ** t)) / (np.sqrt(vi / (1 - 0.999 ** t)) + 1e-8)
    return params


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least logistic loss, on a fine grid."""
    grid = np.geomspace(0.25, 8, 81)
    loss = [np.mean(np.logaddexp(0, -np.where(y > 0, logits, -logits) / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def held_out(doc_id: str | Column = "doc_id", folds: int = FOLDS) -> Column:
    """Whether a document belongs to the fold that is never trained on."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _features(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                body, shape, sizes = buckets_of(part.column("text"))
                x = np.hstack([pool(vectors.value, body, sizes), pool(vectors.value, shape, sizes)])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "quality": part.column("quality"),
                    "x": [r.astype("<f4").tobytes() for r in x]})
    return run


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
                   .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                   .agg(F.min("quality").cast("int").alias("quality"))
                   .where(~held_out()))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
                .join(F.broadcast(sample), "doc_id"))           # max_train rows
    shared = spark.sparkContext.broadcast(vectors)
    found = rows.select("doc_id", "quality", "text").mapInArrow(
        _features(shared), "doc_id long, quality int, x binary")
    # repeated ids: one row each, so the sample stays within its bound
    found = found.groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    got = sorted(((r["doc_id"], r["quality"], r["x"]) for r in found.collect()))
    y = np.array([float(q > 0) for _, q, _ in got])
    if len(set(y)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Model(np.zeros((BUCKETS, HIDDEN), np.float32), np.zeros(HIDDEN), np.zeros(HIDDEN),
                     float(np.log(share / (1 - share))), 1.0)
    x = np.stack([np.frombuffer(r, "<f4") for _, _, r in got]).astype(np.float64)
    mean, std = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / std
    late = np.random.default_rng(SEED).random(len(z)) < CALIBRATION
    if len(set(y[~late])) < 2 or len(set(y[late])) < 2:
        late[:] = False
    w1, b1, w2, b2 = fit_network(z[~late], y[~late])
    check = late if late.any() else ~late
    logits = np.maximum(z[check] @ w1 + b1, 0) @ w2 + b2
    scaled = w1 / std[:, None]
    first = np.vstack([vectors[:WORDS] @ scaled[:DIM], vectors[WORDS:] @ scaled[DIM:]])
    return Model(first.astype(np.float32), b1 - mean @ scaled, w2, float(b2[0]),
                 fit_temperature(logits, y[check]))


# --- scoring ----------------------------------------------------------------

def _score(model, threshold: float, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                s = np.round(model.value.score(part.column("text")), 9)
                if keep:
                    yield part.filter(pa.array(s >= threshold))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("held_out"), pa.array(s, pa.float64()),
                         pa.array((s >= threshold).astype(np.int32))],
                        ["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    return rows.mapInArrow(_score(shared, threshold, False),
                           "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return docs.mapInArrow(_score(shared, threshold, True), schema)
