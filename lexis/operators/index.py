"""Inverted index: postings, dictionary, document and corpus statistics.

Layout (all plain DataFrames, stored as parquet by ``store.save_index``):

* ``postings`` (term, doc_id, tf, n_tokens, n_unique) -- one row per
  distinct (term, document). Document lengths ride along on every posting,
  so ranking never joins the (corpus-sized) document table.
* ``terms``    (term, term_id, df) -- term_id = md5(term): stable across runs.
* ``docs``     (doc_id, n_tokens, n_unique [, extra columns]) -- documents
  with at least one kept token once saved.
* ``corpus``   one row: n_docs, n_tokens, n_postings, avg_unique, avg_tokens.

Postings stay rows on every scoring path: a stop-like term is millions of
rows spread over many tasks, never one giant array.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions.scoring import tf_idf
from lexis.operators.tokens import doc_words
from lexis.profile import LanguageProfile
from lexis.sources.corpus import spread

# A term counts as "hot" when it has at least n_postings / HOT_TERMS_MAX
# postings. Since the df of all terms sums to n_postings, at most
# HOT_TERMS_MAX terms can be hot (a proven broadcast bound), and every other
# term holds under 1 / HOT_TERMS_MAX of all postings (no skewed join key).
HOT_TERMS_MAX = 200_000


@dataclass
class Index:
    postings: DataFrame
    terms: DataFrame
    docs: DataFrame
    corpus: DataFrame
    # of a stored index: postings with the number of their term's part
    parted: DataFrame | None = None
    term_parts: int = 1

    @property
    def sparkSession(self) -> SparkSession:
        return self.postings.sparkSession


def postings_from_words(dw: DataFrame, key: str = "doc_id") -> DataFrame:
    """(term, doc_id, tf, n_tokens, n_unique) from one-row-per-document words.

    All of a document's words sit in one row, so its postings come from the
    row alone -- no aggregation, no shuffle: sort the words, mark where a
    run of equal words starts, and the gap to the next start is the count.
    Each step is its own projection so every array is computed once.
    """
    # No row filter here: a filter on a column derived from ``words`` would be
    # pushed below the tokenizer's projection and run the tokenizer twice.
    # Empty documents simply yield empty arrays.
    s = dw.select(F.col(key).alias("doc_id"), "n_tokens", "n_unique",
                  F.sort_array("words").alias("s"))
    idx = F.sequence(F.lit(1), F.greatest(F.size("s"), F.lit(1)))
    empty = F.array().cast("array<int>")
    s = s.withColumn("starts", F.when(F.size("s") > 0, F.filter(
        idx, lambda i: (i == 1) | (F.try_element_at("s", i) != F.try_element_at("s", i - 1)))
    ).otherwise(empty))
    s = s.withColumn("ends", F.when(F.size("starts") > 0, F.concat(
        F.slice("starts", 2, F.size("starts")), F.array((F.size("s") + 1).cast("int"))))
        .otherwise(empty))
    p = s.select("doc_id", "n_tokens", "n_unique", "s",
                 F.posexplode(F.arrays_zip("starts", "ends")).alias("j", "r"))
    return p.select(F.element_at("s", F.col("r.starts")).alias("term"), "doc_id",
                    (F.col("r.ends") - F.col("r.starts")).cast("long").alias("tf"),
                    "n_tokens", "n_unique")


def terms_from_postings(postings: DataFrame) -> DataFrame:
    """Dictionary with document frequency. Partial aggregation first, so the
    shuffle carries at most one row per term per task, hot terms included."""
    return (postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
                    .select("term", F.md5("term").alias("term_id"), "df"))


def docs_from_postings(postings: DataFrame, docs: DataFrame, counted: bool = False) -> DataFrame:
    """The document table rebuilt from stored postings (whose rows carry the
    document lengths), so the corpus is not tokenized a second time. Extra
    document columns, if any, are joined back by doc_id. With ``counted`` also
    the number of postings as n_rows: it is n_unique unless the key repeats."""
    d = postings.groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"),
                                       F.max("n_unique").alias("n_unique"),
                                       *[F.count(F.lit(1)).alias("n_rows")] * counted)
    extra = [c for c in docs.columns if c not in ("doc_id", "n_tokens", "n_unique")]
    if extra:
        d = d.join(docs.select("doc_id", *extra), "doc_id")
    return d


def corpus_from_docs(docs: DataFrame) -> DataFrame:
    """One-row corpus statistics over documents with at least one token.

    Conditional aggregates rather than a row filter: a filter on n_tokens
    would be pushed below the tokenizer and run it twice.
    """
    has = F.col("n_tokens") > 0
    return docs.agg(F.count(F.when(has, 1)).alias("n_docs"),
                    F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"),
                    F.coalesce(F.sum("n_unique"), F.lit(0)).cast("long").alias("n_postings"),
                    F.coalesce(F.avg(F.when(has, F.col("n_unique"))), F.lit(0.0)).alias("avg_unique"),
                    F.coalesce(F.avg(F.when(has, F.col("n_tokens"))), F.lit(0.0)).alias("avg_tokens"))


def build_index(docs: DataFrame, profile: LanguageProfile, text_cols: Sequence[str] = ("text",),
                key: str = "doc_id", keep: Sequence[str] = ()) -> Index:
    """Lazy index over ``docs``; nothing runs until an action or ``save_index``.

    ``keep`` lists document columns carried into ``docs`` (e.g. url, title).
    """
    dw = doc_words(spread(docs, key), profile, text_cols, key, keep)
    postings = postings_from_words(dw, key)
    # Lazy ``docs`` keeps documents without tokens (n_tokens = 0); the stored
    # table (rebuilt from postings by save_index) holds only the others.
    doc_table = dw.select(F.col(key).alias("doc_id"), "n_tokens", "n_unique", *keep)
    return Index(postings=postings, terms=terms_from_postings(postings),
                 docs=doc_table, corpus=corpus_from_docs(doc_table))


def merge_repeated(docs: DataFrame, text_cols: Sequence[str] = ("text",), key: str = "doc_id",
                   sep: str = "\n") -> DataFrame:
    """Documents with the texts of repeated keys joined into one row each
    (in the order of their text). For inputs whose keys are not known to be
    unique; ``save_index`` refuses repeated keys."""
    text = [F.array_join(F.sort_array(F.collect_list(c)), sep).alias(c) for c in text_cols]
    return docs.groupBy(key).agg(*text)


def materialize(index: Index, path: str) -> Index:
    """The index with its postings written once, as plain Parquet under
    ``path``, and the other tables computed from them: for a plan that reads
    an index in several places, so the corpus is tokenized once. Searches that
    outlive the session use ``save_index``.
    """
    spark, path = index.sparkSession, path.rstrip("/")
    index.postings.write.parquet(f"{path}/postings")
    postings = spark.read.parquet(f"{path}/postings")
    terms_from_postings(postings).write.parquet(f"{path}/terms")
    docs = docs_from_postings(postings, index.docs)
    corpus_from_docs(docs).write.parquet(f"{path}/corpus")
    return Index(postings=postings, terms=spark.read.parquet(f"{path}/terms"), docs=docs,
                 corpus=spark.read.parquet(f"{path}/corpus"))


def corpus_stats(index: Index, n_docs: int | None = None) -> DataFrame:
    """The one-row statistics, with N optionally fixed (e.g. 30)."""
    c = index.corpus
    if n_docs is not None:
        c = c.withColumn("n_docs", F.lit(int(n_docs)).cast("long"))
    return F.broadcast(c)


def posting_blocks(postings: DataFrame, block_size: int = 128) -> DataFrame:
    """Posting lists as (term, block, doc_ids): doc ids of a term grouped by
    doc_id div block_size, sorted. A block holds at most ``block_size`` ids
    (ids are unique within a term), so a stop-like term becomes many bounded
    rows instead of one array as long as the corpus."""
    # whole-number division: as doubles, ids past 2**53 would share blocks
    blk = F.expr(f"(doc_id - pmod(doc_id, {int(block_size)})) div {int(block_size)}")
    return (postings.groupBy("term", blk.alias("block"))
                    .agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids")))


def term_doc_rows(weighted: DataFrame) -> DataFrame:
    """Sparse document rows of the term x document matrix:
    (doc_id, terms, weights), terms sorted; one row per document, bounded
    by the document's own vocabulary."""
    rows = weighted.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "tf_idf"))).alias("e"))
    return rows.select("doc_id", F.col("e.term").alias("terms"), F.col("e.tf_idf").alias("weights"))


def hot_terms(index: Index, hot_terms_max: int = HOT_TERMS_MAX) -> DataFrame:
    """(term) of terms holding at least n_postings / hot_terms_max postings.

    At most ``hot_terms_max`` rows: the df of all terms sums to n_postings.
    """
    stats = F.broadcast(index.corpus.select("n_postings"))
    t = index.terms.select("term", "df").crossJoin(stats)
    return t.where(F.col("df") * F.lit(hot_terms_max) >= F.col("n_postings")).select("term")


def join_term_table(index: Index, rows: DataFrame, table: DataFrame, how: str = "inner",
                    hot_terms_max: int = HOT_TERMS_MAX) -> DataFrame:
    """``rows`` (postings-like, keyed by ``term``) joined to ``table`` (one row
    per term), safe against stop-like terms.

    Hot terms (a proven small set) take a broadcast join, so their rows
    never shuffle; the remaining terms join by shuffle, where no key holds
    more than 1 / hot_terms_max of the postings.
    """
    hot = F.broadcast(hot_terms(index, hot_terms_max))
    # an inner join with the hot terms' table keeps their rows alone
    hot_rows = rows if how == "inner" else rows.join(hot, "term", "left_semi")
    cold_rows = rows.join(hot, "term", "left_anti")
    # one row a term, so at most hot_terms_max rows are broadcast
    hot_table = F.broadcast(table.join(hot, "term", "left_semi").dropDuplicates(["term"]))
    cold_table = table.join(hot, "term", "left_anti")
    return hot_rows.join(hot_table, "term", how).unionByName(cold_rows.join(cold_table, "term", how))


def weighted_postings(index: Index, hot_terms_max: int = HOT_TERMS_MAX, by_term: Sequence[Column] = ()) -> DataFrame:
    """Postings with df and tf_idf = (tf / n_tokens) * ln(N / df), and the columns
    ``by_term``, computed once for each row of the dictionary.

    Joining every posting to its term's df is the one join keyed by term,
    where a stop-like word can hold a third of all rows: see
    ``join_term_table``.
    """
    stats = F.broadcast(index.corpus.select("n_docs"))
    t = index.terms.select("term", "df", *by_term).crossJoin(stats)
    joined = join_term_table(index, index.postings, t, "inner", hot_terms_max)
    return joined.withColumn("tf_idf", tf_idf(F.col("tf"), F.col("n_tokens"), F.col("df"),
                                              F.col("n_docs")))
