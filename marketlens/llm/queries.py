"""Registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import table
from marketlens.llm.decontamination import contaminations
from marketlens.llm.fingerprints import compare_with_next
from marketlens.llm.hard_negatives import EMBEDDING_SQL, mine_embeddings
from marketlens.llm.html_text import extract_pages
from marketlens.llm.language_id import identify_documents
from marketlens.llm.lexical_search import SEARCH_SQL, search
from marketlens.llm.mixing import mix_documents
from marketlens.llm.ngram_join import join_documents
from marketlens.llm.packing import pack_documents
from marketlens.llm.preference import CONVERSATION_SQL, conversation_pairs, format_preferences
from marketlens.llm.private_data import find_documents
from marketlens.llm.sharding import shard_documents
from marketlens.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Vocabulary of the packed sequences, a file of the installed package.
TOKENIZER = "byte_bpe_50k.json"

#: Bytes of a batch that a Python worker gets at once (one row at least).
BATCH_BYTES = 4 << 20


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it,
    and bound the batches of text that they hold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    home = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_preferences(*conversation_pairs(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


ORACLE["op2_preference_format"] = CONVERSATION_SQL


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


@query
def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query
def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE["op12_lexical_search"] = SEARCH_SQL


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_embeddings(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


ORACLE["op13_hard_negatives"] = EMBEDDING_SQL
