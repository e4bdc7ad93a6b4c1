"""Summaries behind the dashboards and the published result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.schemas import GENRES, PLATFORMS, UNKNOWN


def curated_profile(curated: DataFrame) -> DataFrame:
    return (
        curated.where(F.col("is_cross_partition_date") == F.lit(False))
        .groupBy("derived_genre")
        .agg(
            F.count("*").alias("event_count"),
            F.round(F.avg(F.col("is_search_abandoned").cast("int")), 4).alias("abandonment_rate"),
            F.count_distinct("isp_segment").alias("distinct_isps"),
            F.count_distinct("user_id_hashed").alias("unique_users"),
        )
    )


def gold_profile(gold: DataFrame, limit: int = 20) -> DataFrame:
    return (
        gold.groupBy("derived_genre", "platform_group")
        .agg(
            F.count("*").alias("keyword_slots"),
            F.sum("search_count").alias("total_searches"),
            F.round(F.avg("abandonment_rate"), 4).alias("avg_abandonment_rate"),
            F.count_if(F.col("rank_delta") > 0).alias("rising_keywords"),
        )
        .orderBy(F.desc("total_searches"), "derived_genre", "platform_group")
        .limit(limit)
    )


def genre_distribution(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("derived_genre")
        .agg(F.count("*").alias("slots"), F.sum("search_count").alias("searches"))
        .orderBy(F.desc("searches"), "derived_genre")
    )


def abandonment_heatmap(gold: DataFrame) -> DataFrame:
    """Average abandonment, genres down, platforms across."""
    return gold.groupBy("derived_genre").pivot("platform_group", list(PLATFORMS)).agg(F.avg("abandonment_rate"))


def isp_platform_heatmap(gold: DataFrame) -> DataFrame:
    return gold.groupBy("isp_segment").pivot("platform_group", list(PLATFORMS)).agg(F.sum("unique_users"))


def classifier_coverage(gold: DataFrame) -> DataFrame:
    """Search volume with and without a genre, and the shares in percent."""
    known = F.col("derived_genre") != UNKNOWN
    volume = gold.agg(
        F.coalesce(F.sum(F.when(known, F.col("search_count"))), F.lit(0)).alias("classified"),
        F.coalesce(F.sum(F.when(~known, F.col("search_count"))), F.lit(0)).alias("unknown"),
    )
    total = F.nullif(F.col("classified") + F.col("unknown"), F.lit(0))
    return volume.withColumns(
        {"classified_pct": 100 * F.col("classified") / total, "unknown_pct": 100 * F.col("unknown") / total}
    )


def baseline_coverage(base: DataFrame, genres: int = len(GENRES)) -> DataFrame:
    """Baseline slots present against genres × 24 hours."""
    return base.agg(F.count("*").alias("slots"), F.lit(genres * 24).cast("bigint").alias("expected_slots"))
