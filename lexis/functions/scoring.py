"""Scoring formulas as column expressions.

Constants below are the ranking defaults being matched; every formula is a
plain expression so Catalyst folds and codegens it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
BM25_K1 = 1.2
BM25_B = 0.75
TOP_K = 10          # results per query (vector, BM25, LSA)
LSA_RANK = 5        # kept singular values
# ---------------------------------------------------------------------------

# Scores are reported rounded to this many decimals. They are ranked on this
# many significant digits, with doc_id ascending as tie-break: documents with
# equal statistics then rank the same whatever order the sums were added in,
# and small scores keep their order.
SCORE_DIGITS = 9
RANK_DIGITS = 10


def safe_div(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 or NULL (ANSI mode would raise)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def tf_idf(tf: Column, n_tokens: Column, df: Column, n_docs: Column) -> Column:
    """(count in doc / tokens in doc) * ln(N / df), natural log."""
    return (tf.cast("double") / n_tokens) * F.ln(n_docs.cast("double") / df)


def vector_idf(df: Column, n_docs: Column) -> Column:
    return F.ln(n_docs.cast("double") / df)


def bm25_idf(df: Column, n_docs: Column) -> Column:
    """max(0, ln((N - df + 0.5) / (df + 0.5)))."""
    return F.greatest(F.ln((n_docs - df + F.lit(0.5)) / (df + F.lit(0.5))), F.lit(0.0))


def bm25_term(idf: Column, tf: Column, length: Column, avg_length: Column,
              k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """idf * tf*(k1+1) / (tf + k1*(1 - b + b*len/avg))."""
    norm = F.lit(1.0 - b) + safe_div(F.lit(b) * length, avg_length)
    return idf * (tf * F.lit(k1 + 1.0)) / (tf + F.lit(k1) * norm)


def cosine(dot: Column, q2: Column, d2: Column, metric: str = "cosine") -> Column:
    """Similarity from a dot product and two squared norms.

    ``cosine``: dot / (|q| * |d|).
    ``reference``: dot / |q| * |d| -- the operator-precedence form of the
    ranking being matched, kept as its own metric.
    A zero norm gives 0.0 instead of NaN.
    """
    if metric == "cosine":
        return safe_div(dot, F.sqrt(q2) * F.sqrt(d2))
    if metric == "reference":
        return safe_div(dot, F.sqrt(q2)) * F.sqrt(d2)
    raise ValueError(f"unknown metric {metric!r}")


def ranking(score: Column, digits: int = RANK_DIGITS) -> Column:
    """The score to ``digits`` significant digits, as a number in the same
    order: scores of one power of ten are told apart by their rounded
    mantissa."""
    exponent = F.floor(F.log10(F.abs(score)))
    step = F.pow(F.lit(10.0), exponent - (digits - 1))
    return F.when(F.abs(score) < F.lit(1e-290), F.lit(0.0)).otherwise(F.round(score / step) * step)


def report(score: Column) -> Column:
    return F.round(score, SCORE_DIGITS)
