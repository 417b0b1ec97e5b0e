"""The corpus pipeline: from documents to mixed, sharded training documents.

Each stage gets what its predecessor kept, as a stored table, and its
decisions take effect; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import table
from marketlens.llm.decontamination import clean_stage
from marketlens.llm.language_id import keep_identified
from marketlens.llm.mixing import mix_stage
from marketlens.llm.ngram_join import keep_one
from marketlens.llm.queries import reach_workers
from marketlens.llm.sharding import shard_stage
from marketlens.sources.sinks import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    reach_workers(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal or similar texts stays."""
    reach_workers(spark)
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    reach_workers(spark)
    return clean_stage(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    reach_workers(spark)
    return mix_stage(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    reach_workers(spark)
    return shard_stage(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
