"""Latent factors of the whole corpus, found once and stored.

``lsa_search`` takes an SVD for every query. Here one truncated SVD of the
documents x words matrix A (tf-idf weights) serves all queries: A ~ U S V^T.
Stored are a row of V_k S_k^-1 per word and a row of U_k per document. A query
folds in as the sum of its known words' rows, and its candidates (documents
with at least one of its words) are compared with it in k dimensions.

Randomised block iteration, on Spark tables only:

* probe: Y = A W, W[t, c] = +1 or -1 by the c-th hex digit of the word's md5,
  so W is never stored, joined or seeded by a task;
* step:  Z = A^T P by word, P a basis of Y's columns, Q = an orthonormal basis of
  Z's columns, Y = A Q by document. Steps go on until the k largest singular
  values of Y settle, or ``max_steps``; ``Latent.settled`` says which;
* end:   with Y = P R and R = X S T^T the factors are S, Q T and Y T S^-1.

A is written once, in blocks of a part of the documents each (``latent_blocks``), and
stays where it is. A step sends a row for each (part, word) to the word's group and, as
the sum, back, but for words of one part; so both products are made where the part's
entries lie, and a task holds one group of words at a time. Parts reduce
their documents' rows, and the words' rows they count, to l x l triangular factors
(l = probes), merged along the tree of ``lsa.triangular_factors``: about
``MERGE_FAN_IN`` of them, whatever the corpus, reach the driver. The bases are l x l
matrices that go along with the next step.

Defined cases: an index without documents, or with no weight above zero, gives
no component, and every candidate scores 0. A matrix of lower rank gives fewer
components. Words that the corpus lacks add nothing to a query.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions.scoring import LSA_RANK, TOP_K, cosine
from lexis.operators.index import HOT_TERMS_MAX, Index, weighted_postings
from lexis.operators.latent_blocks import (OF_ROWS, OF_WORDS, Blocks, document_table, documents_of, factor, kept,
                                           signed, store_blocks, word_table, words_of)
from lexis.operators.lsa import LSA_RCOND
from lexis.operators.query import candidate_postings, is_small, maybe_broadcast
from lexis.operators.topk import top_k
from lexis.session import scratch_path

# Python workers get this module's functions by value, as in ``lsa``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of the block; those past the wanted rank make the steps converge.
PROBES = 16
#: Steps end when no wanted singular value changes by more than this part of it.
TOLERANCE = 1e-5
MAX_STEPS = 12
#: Hex digits of one md5: a block of more columns takes further digests.
_DIGITS = 32


@dataclass
class Latent:
    """Stored factors: words (term, f0..), docs (doc_id, d0..), singular values
    in falling order, and whether they settled within the steps allowed."""
    words: DataFrame
    docs: DataFrame
    values: list[float]
    settled: bool

    @property
    def rank(self) -> int:
        return len(self.values)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _signs(probes: int) -> list[Column]:
    """A word's row of W as bits: bit c of _s<d> is set where the word's md5 of
    number d has a hex digit of 8 or more at c, for -1."""
    out = []
    for d in range(-(-probes // _DIGITS)):
        h = F.md5(F.concat(F.col("term"), F.lit(f":{d}")))
        bits = [F.when(F.substring(h, c + 1, 1) < "8", F.lit(0)).otherwise(F.lit(1 << c)).cast("long")
                for c in range(min(_DIGITS, probes - d * _DIGITS))]
        out.append(sum(bits[1:], bits[0]).alias(f"_s{d}"))
    return out


def entries(index: Index, probes: int = PROBES) -> DataFrame:
    """(doc_id, term, w, _s0..): the entries of A, lazily, with their words' signs."""
    signs = _signs(probes)
    return weighted_postings(index, by_term=signs).select(
        "doc_id", "term", F.col("tf_idf").alias("w"), *[f"_s{d}" for d in range(len(signs))])


def _block(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{c}" for c in range(n)]


def probe(a: DataFrame, probes: int = PROBES) -> DataFrame:
    """(doc_id, y0..): A W. A document's words meet in its bucket. The signs come
    with the entries, looked up with their words' weights: no digest of each."""
    def sign(c: int) -> Column:
        bit = F.col(f"_s{c // _DIGITS}").bitwiseAND(F.lit(1 << c % _DIGITS).cast("long"))
        return F.when(bit == 0, F.col("w")).otherwise(-F.col("w"))
    return a.groupBy("doc_id").agg(*[F.sum(sign(c)).alias(y) for c, y in enumerate(_block("y", probes))])


def by_word(a: DataFrame, y: DataFrame) -> DataFrame:
    """(term [, frequent], z0..): A^T Y. Partial sums first, so a frequent word
    sends one row for each task."""
    ys, keys = [c for c in y.columns if c != "doc_id"], [c for c in ("term", "frequent") if c in a.columns]
    return a.join(y, "doc_id").groupBy(*keys).agg(
        *[F.sum(F.col("w") * F.col(c)).alias(f"z{i}") for i, c in enumerate(ys)])


def small_svd(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero singular values, falling, and right singular vectors as columns."""
    if not r.shape[0]:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    _, s, right = np.linalg.svd(r, full_matrices=False)
    keep = (s > 0) & (s >= LSA_RCOND * s[0])
    return s[keep], right[keep].T


def fit_latent(index: Index, path: str, rank: int = LSA_RANK, probes: int = PROBES,
               tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS, words_max: int = HOT_TERMS_MAX) -> Latent:
    """Factors of ``index`` (stored or materialised: it is read in every step)
    under ``path``, with min(rank, rank of A) components."""
    if not 0 < rank <= probes or max_steps < 1:
        raise ValueError("probes must be at least the rank, rank and steps at least 1")
    spark, name = index.sparkSession, f"lexis_latent_{uuid.uuid4().hex[:16]}"
    try:
        a = store_blocks(index, f"{path}/entries", name, _signs(probes), words_max)
        return _fitted(spark, index, a, name, path, rank, probes, tolerance, max_steps)
    finally:
        for table in (name, f"{name}_probe", *(f"{name}_{step}" for step in range(max_steps))):
            spark.sql(f"DROP TABLE IF EXISTS {table}")   # its files stay


def _fitted(spark: SparkSession, index: Index, a: Blocks, name: str, path: str, rank: int, probes: int,
            tolerance: float, max_steps: int) -> Latent:
    y, basis = kept(a, signed(a, probes, _DIGITS), f"{name}_probe", f"{path}/probe"), np.eye(probes)
    before, settled, s = None, False, np.zeros(0)
    for step in range(max_steps):
        last, by = y, basis                              # what the words' rows are made of
        product = documents_of(a, words_of(a, last, by), by.shape[1], last, by)
        y = kept(a, product, f"{name}_{step}", f"{path}/documents-{step}")
        sz, vz = small_svd(factor(a, y, OF_WORDS, by.shape[1]))
        if not len(sz):
            break
        q = vz / sz                                      # Z q is orthonormal; the rows of y are A Z
        s, t = small_svd(factor(a, y, OF_ROWS, by.shape[1]) @ q)
        now = s[:rank]
        settled = before is not None and len(now) == len(before) and bool(
            np.all(np.abs(now - before) <= tolerance * now))
        if settled:
            break
        before, basis = now, q @ (t / s)
    if not len(s):                                       # no weight above zero
        return Latent(words=_written(index.terms.select("term"), f"{path}/words"),
                      docs=_written(index.docs.select("doc_id"), f"{path}/docs"), values=[], settled=True)
    s, m = s[:rank], q @ (t[:, :rank] / s[:rank])
    words, docs = word_table(a, words_of(a, last, by, keyed=True), m, "f"), document_table(a, y, m, "d")
    words.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{path}/words")
    docs.write.parquet(f"{path}/docs")
    spark.createDataFrame([(i, float(v), settled) for i, v in enumerate(s)],
                          "component int, value double, settled boolean").coalesce(1).write.parquet(f"{path}/values")
    return load_latent(spark, path)


def load_latent(spark: SparkSession, path: str) -> Latent:
    """Factors that ``fit_latent`` stored under ``path``."""
    values = spark.read.parquet(f"{path}/values").orderBy("component").collect()
    return Latent(words=spark.read.parquet(f"{path}/words"), docs=spark.read.parquet(f"{path}/docs"),
                  values=[r.value for r in values], settled=bool(values and values[0].settled))


def folded_queries(model: Latent, qterms: DataFrame, small: bool | None = None) -> DataFrame:
    """(query_id, q0..): q . V_k . S_k^-1 with q = 1 for every known word. The
    words are only streamed past the query batch."""
    if small is None:
        small = is_small(qterms)
    known = model.words.join(maybe_broadcast(qterms.select("query_id", "term").distinct(), small), "term")
    return known.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_known"),
        *[F.sum(f"f{c}").alias(f"q{c}") for c in range(model.rank)])


def latent_scores(index: Index, model: Latent, qterms: DataFrame, metric: str = "reference") -> DataFrame:
    """(query_id, doc_id, score) for every candidate. Postings are read once,
    and nothing but their document is used of them."""
    small = is_small(qterms)
    folded, comps = folded_queries(model, qterms, small), range(model.rank)
    words = qterms.select("query_id", "term").distinct()
    pairs = candidate_postings(index, words, small, qterms).select("query_id", "doc_id").distinct()
    rows = (pairs.join(model.docs, "doc_id", "left")
                 .join(maybe_broadcast(folded, small and is_small(folded)), "query_id"))

    def inner(x: str, y: str) -> Column:
        return sum((F.coalesce(F.col(f"{x}{c}") * F.col(f"{y}{c}"), F.lit(0.0)) for c in comps), F.lit(0.0))
    return rows.select("query_id", "doc_id", cosine(inner("q", "d"), inner("q", "q"), inner("d", "d"), metric)
                       .alias("score"))


def latent_search(index: Index, model: Latent, qterms: DataFrame, k: int = TOP_K,
                  metric: str = "reference") -> DataFrame:
    """Top-k ranking by corpus-wide factors: (query_id, rank, doc_id, score)."""
    return top_k(latent_scores(index, model, qterms, metric), k).select("query_id", "rank", "doc_id", "score")


def latent_query(index: Index, qterms: DataFrame, metric: str = "reference") -> DataFrame:
    """Fit in a scratch folder, then search."""
    return latent_search(index, fit_latent(index, scratch_path(index.sparkSession, "latent")), qterms, metric=metric)
