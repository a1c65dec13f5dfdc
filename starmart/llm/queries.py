"""The operators by query name, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    decontamination,
    lattice,
    main_text,
    neardup,
    neighbours,
    packing,
    private_data,
    quality_rules,
    sharding,
    spelling,
    toxicity,
    trie,
    url_filter,
)
from starmart.llm.common import table
from starmart.llm.expected import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.score_documents(table(spark, folder, "documents"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.score_documents(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return neighbours.score_documents(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_text(table(spark, folder, "pages"))


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_private_data(spark: SparkSession, folder: str) -> DataFrame:
    return private_data.find(table(spark, folder, "documents"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and name[2:3].isdigit()
}
