"""Tokenization of documents and queries (one shared code path)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexis.functions.text import field_words
from lexis.profile import LanguageProfile
from lexis.sources.corpus import spread


def doc_words(docs: DataFrame, profile: LanguageProfile, text_cols: Sequence[str] = ("text",),
              key: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: (key, *keep, words array<string>, n_tokens, n_unique).

    Several text columns are tokenized field by field and concatenated, in
    the order given. Per-document counts come from the array itself, so no
    aggregation (and no shuffle) is needed for document lengths.
    """
    w = field_words([F.col(c) for c in text_cols], profile)
    return (docs.select(F.col(key), *keep, w.alias("words"))
                .withColumn("n_tokens", F.size("words").cast("long"))
                .withColumn("n_unique", F.size(F.array_distinct("words")).cast("long")))


def tokens(docs: DataFrame, profile: LanguageProfile, text_cols: Sequence[str] = ("text",),
           key: str = "doc_id") -> DataFrame:
    """One row per kept token: (key, pos, term); pos counts kept tokens from 0.

    ``posexplode_outer`` plus a filter on its output: a plain ``posexplode``
    makes the optimizer infer ``size(words) > 0`` and push it below the
    projection, which would run the tokenizer twice per document.
    """
    dw = doc_words(spread(docs, key), profile, text_cols, key)
    return (dw.select(key, F.posexplode_outer("words").alias("pos", "term"))
              .where(F.col("term").isNotNull()))


def parse_queries(queries: DataFrame, profile: LanguageProfile, key: str = "query_id",
                  text: str = "text") -> DataFrame:
    """Query text to (query_id, term, qtf, first_pos, n_terms).

    The corpus tokenizer is reused as is, so stop words and stemming agree.
    ``qtf`` counts repeats of a word in the query; ``first_pos`` keeps word
    order; ``n_terms`` is the number of distinct words of the query. The
    window runs per query, a group bounded by the query's length.
    """
    t = tokens(queries, profile, (text,), key)
    per_term = (t.groupBy(key, "term")
                 .agg(F.count(F.lit(1)).alias("qtf"), F.min("pos").alias("first_pos")))
    return per_term.withColumn("n_terms", F.count(F.lit(1)).over(Window.partitionBy(key)))
