"""BM25 over blocks of documents with score bounds: blocks that cannot reach a
query's k-th score are not read.

A BM25 weight here falls as a document has more distinct words, so the least
``n_unique`` among a word's postings in a block bounds its weight there, and a
query's sum of these bounds any score in the block. Documents of like length
share a band (four to a doubling), and a band is dealt by a hash of doc_id into
blocks of about ``BLOCK_DOCS`` documents. Stored are the postings, in a folder
for each band and sorted by block and word, and one bound row for each (word,
block): at most one for every posting, and for a frequent word one for thousands.

A search reads the bound rows of its words, scores the k blocks of highest bound
(each holds a candidate, so the k-th best score found is a lower limit of the
true one), and then the blocks whose bound is not below that limit. All of a
document's words are in its block, so scores are those of ``bm25_search``; a
little slack (``SLACK``) covers the order in which sums are added.

Defined cases: queries with fewer than k candidates read all their blocks; a
limit of 0 (only words of no weight) excludes nothing; unknown words and empty
tables give no rows, as in ``bm25_search``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexis.functions.scoring import BM25_B, BM25_K1, TOP_K, bm25_term
from lexis.operators.bm25 import bm25_idf_table
from lexis.operators.index import Index
from lexis.operators.query import hot_join, is_small, maybe_broadcast
from lexis.operators.topk import top_k
from lexis.session import scratch_path

#: Documents in a block, about.
BLOCK_DOCS = 4096
#: Bands to a doubling of the document length, and the most there can be: the
#: table of bands is broadcast, and its numbers prune folders.
BANDS_PER_DOUBLING = 4
MAX_BANDS = 256
#: Part by which a bound may lie under the limit: ranks go by ten digits.
SLACK = 1e-8
# A block's number is its band's times this plus its number in the band.
_BAND_STEP = 1 << 40


@dataclass
class BoundedPostings:
    """postings (term, doc_id, n_unique, block, band) and bounds (term, block,
    least_unique, n_docs)."""
    postings: DataFrame
    bounds: DataFrame


def band(n_unique: Column) -> Column:
    """The band of a document's length."""
    length = F.greatest(n_unique, F.lit(1)).cast("double")
    return F.least(F.floor(F.log2(length) * BANDS_PER_DOUBLING), F.lit(MAX_BANDS - 1)).cast("int")


def store_bounded(index: Index, path: str, block_docs: int = BLOCK_DOCS) -> BoundedPostings:
    """Write the blocks and bounds of ``index`` under ``path``."""
    spark = index.sparkSession
    bands = (index.docs.where(F.col("n_unique") > 0).groupBy(band(F.col("n_unique")).alias("band"))
                       .agg(F.ceil(F.count(F.lit(1)) / F.lit(int(block_docs))).cast("long").alias("blocks")))
    p = index.postings.select("term", "doc_id", "n_unique", band(F.col("n_unique")).alias("band"))
    p = p.join(F.broadcast(bands), "band")               # MAX_BANDS rows at most
    p = p.withColumn("block", F.col("band") * F.lit(_BAND_STEP) + F.pmod(F.xxhash64("doc_id"), "blocks")).drop("blocks")
    (p.repartition("block").sortWithinPartitions("band", "block", "term")
      .write.partitionBy("band").parquet(f"{path}/postings"))
    stored = spark.read.schema(p.schema).parquet(f"{path}/postings")
    (stored.groupBy("term", "block").agg(F.min("n_unique").alias("least_unique"), F.count(F.lit(1)).alias("n_docs"))
           .sortWithinPartitions("term").write.parquet(f"{path}/bounds"))
    return load_bounded(spark, path, p.schema["doc_id"].dataType.simpleString())


def load_bounded(spark: SparkSession, path: str, key_type: str = "bigint") -> BoundedPostings:
    """What ``store_bounded`` wrote; ``key_type`` is the type of doc_id."""
    return BoundedPostings(
        postings=spark.read.schema(f"term string, doc_id {key_type}, n_unique long, block long, band int")
                           .parquet(f"{path}/postings"),
        bounds=spark.read.parquet(f"{path}/bounds"))


def _weight(length: Column, k1: float, b: float) -> Column:
    length = length.cast("double")
    return F.col("qtf") * bm25_term(F.col("idf"), F.lit(1.0) / length, length, F.col("avg_unique"), k1, b)


def block_bounds(bounded: BoundedPostings, q: DataFrame, small: bool, k1: float = BM25_K1,
                 b: float = BM25_B) -> DataFrame:
    """(query_id, block, bound) for every block with a word of the query."""
    hits = hot_join(bounded.bounds, q, "term", small=small)
    return hits.groupBy("query_id", "block").agg(F.sum(_weight(F.col("least_unique"), k1, b)).alias("bound"))


def block_postings(bounded: BoundedPostings, q: DataFrame, blocks: DataFrame, small: bool) -> DataFrame:
    """Postings of the queries' words in the blocks chosen for each. Only the
    folders of their bands are listed; a (word, block) holds a block's
    documents at most, so no join key is hot."""
    bands = blocks.select(F.expr(f"cast(block div {_BAND_STEP} as int)").alias("band")).distinct().collect()
    wanted = q.join(maybe_broadcast(blocks.select("query_id", "block"), is_small(blocks)), "query_id")
    rows = bounded.postings.where(F.col("band").isin([r.band for r in bands])).drop("band")
    return rows.join(maybe_broadcast(wanted, small and is_small(wanted)), ["term", "block"])


def _scores(hits: DataFrame, k1: float, b: float) -> DataFrame:
    return hits.groupBy("query_id", "doc_id").agg(F.sum(_weight(F.col("n_unique"), k1, b)).alias("score"))


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks_to_read(bounded: BoundedPostings, q: DataFrame, k: int, small: bool, k1: float = BM25_K1,
                   b: float = BM25_B) -> DataFrame:
    """(query_id, block, bound) of the blocks that may hold one of a query's
    k best documents."""
    blocks = _written(block_bounds(bounded, q, small, k1, b), "block-bounds")
    best = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
    first = blocks.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= k).drop("_at")
    first = _written(first, "first-blocks")              # k rows a query at most
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    limit = (_scores(block_postings(bounded, q, first, small), k1, b)
             .withColumn("_at", F.row_number().over(by_score)).where(F.col("_at") <= k).where(F.col("_at") == k)
             .select("query_id", F.col("score").alias("limit")))
    limit = _written(limit, "block-limits")              # a row a query at most
    kept = blocks.join(maybe_broadcast(limit, is_small(limit)), "query_id", "left")
    return kept.where(F.col("limit").isNull() | (F.col("bound") >= F.col("limit") * F.lit(1.0 - SLACK))).drop("limit")


def bounded_search(index: Index, bounded: BoundedPostings, qterms: DataFrame, k: int = TOP_K,
                   k1: float = BM25_K1, b: float = BM25_B, n_docs: int | None = None) -> DataFrame:
    """Top-k BM25, the rows of ``bm25_search``: (query_id, rank, doc_id, score)."""
    if k1 < 0 or not 0 <= b <= 1:
        raise ValueError("bounds need k1 >= 0 and 0 <= b <= 1")
    small = is_small(qterms)
    q = _written(bm25_idf_table(index, qterms, n_docs, small).select("query_id", "term", "qtf", "idf", "avg_unique"),
                 "query-weights")
    blocks = _written(blocks_to_read(bounded, q, k, small, k1, b), "blocks")
    s = _scores(block_postings(bounded, q, blocks, small), k1, b)
    return top_k(s, k).select("query_id", "rank", "doc_id", "score")
