"""The registered queries of these operators, over their whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rainpanel.llm import (
    bpe, chat, neighbours, packing, quality, resampling, sharding, simhash, spelling, toxicity, url_filter, vectors, warc,
)
from rainpanel.llm.common import table


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards_query(table(spark, folder, "documents"))


def op2_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.perspectives_query(table(spark, folder, "conversations"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_query(table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_query(table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.warc_query(table(spark, folder, "pages"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.urls_query(table(spark, folder, "pages"))


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_query(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbours_query(table(spark, folder, "embeddings"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants_query(table(spark, folder, "documents"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampling_query(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_chat_perspectives, op3_byte_bpe, op4_simhash, op5_packing, op6_warc, op7_url_filter,
        op8_embedding_dedup, op9_quality_rules, op10_toxicity,
        op11_nearest_neighbours, op12_spelling_variants, op13_importance_resampling)}
SQL: dict[str, str] = {
    "op2_chat_perspectives": chat.perspectives_sql(),
    "op7_url_filter": url_filter.urls_sql(),
    "op9_quality_rules": quality.quality_sql(),
}
