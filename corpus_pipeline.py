"""Corpus pipeline: five operators of ``lexis.llm`` from documents to token ids.

``STAGES`` lists (name, function) in order. A function takes (spark, docs,
sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the
shared checkpoint folder and reads it back as the next one's docs. All but the
last return the columns of ``documents``.

Stages take what their operators define for nulls, empty texts, repeated rows
and empty tables: see the operators' docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexis.llm import decontaminate, mixing, quality, registry, simhash
from lexis.llm.common import saved
from lexis.sources.corpus import table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, registry.quality_model(spark, docs, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage by the contract's measure."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix takes it."""
    return mixing.mix(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token id shards, as read back: doc_id, start, n_tokens, ids_crc32."""
    return registry.token_digests(docs)


STAGES = [
    ("quality_classifier", classify),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminated),
    ("mixing", mixed),
    ("token_ids", token_shards),
]

#: The classifier and the random mix have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
