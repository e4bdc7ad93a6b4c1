"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import (
    chat_format,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    mixing,
    oracles,
    quality_gam,
    quality_rules,
    simhash_dedup,
    suffix_dedup,
    toxicity,
    turn_repair,
    whitening,
)
from trendloom.llm.common import source

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(source(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(source(spark, sf_dir, "documents"), source(spark, sf_dir, "labels"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
        " AS t(conv_id, turn, role, text)"
    )
    turns = source(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.formatted_conversations(turns.unionByName(marked)))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(source(spark, sf_dir, "documents"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(source(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(source(spark, sf_dir, "documents"), source(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(source(spark, sf_dir, "documents"), source(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(source(spark, sf_dir, "documents"))


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.scored(source(spark, sf_dir, "documents"), source(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(source(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(source(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(source(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(source(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_chat_format": op3_chat_format,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality_rules": op7_quality_rules,
    "op8_license_scan": op8_license_scan,
    "op9_quality_gam": op9_quality_gam,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_turn_repair": op13_turn_repair,
}

ORACLES: dict[str, str] = {
    "op3_chat_format": oracles.OP3,
    "op7_quality_rules": oracles.OP7,
    "op8_license_scan": oracles.OP8,
    "op12_line_dedup": oracles.OP12,
}
