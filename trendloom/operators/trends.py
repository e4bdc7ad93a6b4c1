"""Gold keyword trends and the views on them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.operators.skew import rank_desc
from trendloom.schemas import GOLD
from trendloom.session import stage
from trendloom.sources.raw_events import DateWindow

# Fixed value: the rank that stands for "no history".
NO_RANK = 9999

_SLOT = ["derived_genre", "platform_group"]
_GRAIN = ["trend_date", *_SLOT, "network_type_norm", "isp_segment", "keyword_norm"]


def valid_rows(curated: DataFrame) -> DataFrame:
    """Rows with a keyword and a known, matching partition year; a null flag is left out too."""
    return curated.where(F.col("keyword_norm").isNotNull() & (F.col("is_cross_partition_date") == F.lit(False)))


def enter_count() -> Column:
    return F.count_if(F.col("session_action") == "enter")


def keyword_daily_stats(curated: DataFrame, window: DateWindow | None = None) -> DataFrame:
    """Measures per day, genre, platform, network, ISP and keyword."""
    rows = valid_rows(curated)
    if window:
        rows = rows.where(window.covers(F.col("dt")))
    n, users = F.count("*"), F.count_distinct("user_id_hashed")
    return rows.groupBy(F.col("dt").try_cast("date").alias("trend_date"), *_GRAIN[1:]).agg(
        n.alias("search_count"),
        enter_count().alias("enter_count"),
        (1 - enter_count() / n).alias("abandonment_rate"),
        users.alias("unique_users"),
        (users / n).alias("authenticated_rate"),
        F.avg(F.col("is_repeat_search").cast("int")).alias("repeat_search_rate"),
        F.avg(F.col("has_premium").cast("int")).alias("premium_search_rate"),
    )


def enter_counts_trailing(curated: DataFrame, as_of: date) -> DataFrame:
    """Enter events per genre, platform and keyword from 8 to 2 days before ``as_of``."""
    window = DateWindow.trailing(as_of, first=8, last=2)
    rows = valid_rows(curated).where(window.covers(F.col("dt")))
    return rows.groupBy(*_SLOT, "keyword_norm").agg(enter_count().alias("enter_count"))


def rank_history(curated: DataFrame, as_of: date) -> DataFrame:
    counts = stage(enter_counts_trailing(curated, as_of), "trailing-counts")
    ranked = rank_desc(counts, _SLOT, "enter_count", "rank_7d_ago")
    return ranked.select(*_SLOT, "keyword_norm", "rank_7d_ago")


def with_rank_history(ranked: DataFrame, history: DataFrame) -> DataFrame:
    """Add the earlier rank and the climb since; keywords without history count as rank 9999."""
    earlier = F.coalesce("rank_7d_ago", F.lit(NO_RANK))
    return (
        ranked.join(history, [*_SLOT, "keyword_norm"], "left")
        .withColumn("rank_7d_ago", earlier)
        .withColumn("rank_delta", F.col("rank_7d_ago") - F.col("rank_today"))
    )


def keyword_trends(
    curated: DataFrame,
    as_of: date,
    window: DateWindow | None = None,
    top_k: int = 50,
    rank_by_date: bool = False,
) -> DataFrame:
    """The gold table: the ``top_k`` keywords of each genre and platform, ties included.

    Ranks run across all days in scope, as each (day, network, ISP, keyword) is one entry, while
    history ranks a keyword as a whole. ``rank_by_date`` ranks each day by itself instead. The aggregated
    statistics are written once, as ranking reads them twice; the curated table is read once for each of the two.
    """
    scope = (["trend_date"] if rank_by_date else []) + _SLOT
    stats = keyword_daily_stats(curated, window or DateWindow.last_days(as_of, 1))
    today = rank_desc(stage(stats, "daily-stats"), scope, "enter_count", "rank_today", limit=top_k)
    return with_rank_history(today, rank_history(curated, as_of)).select(*GOLD.names)


def top_keywords_by_genre(gold: DataFrame, genre: str, limit: int = 5) -> DataFrame:
    order = [F.desc("search_count"), "keyword_norm", "trend_date", "platform_group", "network_type_norm", "isp_segment"]
    return gold.where(F.col("derived_genre") == genre).orderBy(*order).limit(limit)


def trend_icon(delta: Column) -> Column:
    return F.when(delta > 0, "↑").when(delta < 0, "↓").otherwise("→")


def keyword_leaderboard(gold: DataFrame, genre: str, platform: str) -> DataFrame:
    rows = gold.where((F.col("derived_genre") == genre) & (F.col("platform_group") == platform))
    return rows.withColumn("trend_icon", trend_icon(F.col("rank_delta"))).orderBy(F.desc("enter_count"), "keyword_norm")


def new_entrants(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("rank_7d_ago") == NO_RANK)
