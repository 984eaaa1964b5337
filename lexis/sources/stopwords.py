"""Stop-word lists: one word per line, read as a Spark text source."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexis.operators.query import hot_join
from lexis.operators.tokens import tokens
from lexis.profile import LanguageProfile

RESOURCES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "resources")
# English list shipped with Spark MLlib (StopWordsRemover), exported as a file.
ENGLISH = os.path.join(RESOURCES, "stopwords-en.txt")
# Lists of up to this many words are compiled next to the tokenizer; longer
# ones are an anti join (``tokens_without``).
STOP_LIST_MAX = 100_000


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """(word) from a text file: byte-order mark stripped, lines trimmed,
    blank lines and multi-word phrases dropped (no token holds a space).

    A file beside the driver (the lists of this package) is read there and
    shipped with the job; executors need no copy of it. Anything else is read
    by Spark.
    """
    if os.path.isfile(path):
        return spark.createDataFrame([(w,) for w in file_words(path)], "word string")
    w = F.trim(F.regexp_replace(F.col("value"), "^\\x{FEFF}", ""))
    return (spark.read.text(path).select(w.alias("word"))
                 .where((F.col("word") != "") & ~F.col("word").rlike(r"\s")).distinct())


def stop_word_list(spark: SparkSession, path: str) -> list[str]:
    """The list as Python strings for a ``LanguageProfile`` (compiled into a
    hash-set test next to the tokenizer). Size-checked before collecting."""
    df = read_stop_words(spark, path)
    if df.count() > STOP_LIST_MAX:
        raise ValueError(f"stop list {path} is too long to inline; use tokens_without")
    return sorted(r.word for r in df.collect())


def tokens_without(docs: DataFrame, profile: LanguageProfile, stop: DataFrame,
                   text_cols: Sequence[str] = ("text",), key: str = "doc_id",
                   inline_max: int | None = None) -> DataFrame:
    """Tokens (key, pos, term) of ``docs`` without the words of ``stop``; the
    same rows whether the list is compiled in or, past ``inline_max`` words,
    joined. A profile that stems must be given an inlined list, since stop
    words are matched before stemming."""
    limit = STOP_LIST_MAX if inline_max is None else inline_max
    if stop.count() <= limit:
        return tokens(docs, profile.with_stop_words([r.word for r in stop.collect()]), text_cols, key)
    if profile.stemmer:
        raise ValueError("a joined stop list cannot precede the stemmer")
    kept = remove_stop_words(tokens(docs, profile, text_cols, key), stop)
    order = Window.partitionBy(key).orderBy("pos")
    return kept.withColumn("pos", F.row_number().over(order) - 1).select(key, "pos", "term")


def file_words(path: str) -> list[str]:
    """Same cleaning in plain Python (used to write the SQL twin)."""
    out = []
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            w = line.lstrip("\ufeff").strip()
            if w and not any(c.isspace() for c in w):
                out.append(w)
    return sorted(set(out))


def remove_stop_words(rows: DataFrame, stop: DataFrame, term: str = "term") -> DataFrame:
    """Anti join of token rows with a stop-word table.

    Stop words are the hottest keys there are: a list that measures small is
    broadcast, so no token shuffles; a longer one is salted.
    """
    return hot_join(rows, stop.select(F.col("word").alias(term)).distinct(), term, "left_anti")
