"""Baselines per genre and hour, and z-scores against them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.timestamps import local_hour
from trendloom.schemas import UNKNOWN
from trendloom.sources.raw_events import DateWindow

SLOT = ["derived_genre", "hour_of_day_vn"]
_TTL_SECONDS = 30 * 24 * 3600


def four_places(c: Column) -> Column:
    return c.cast("decimal(18,4)")


def daily_enter_counts(
    curated: DataFrame, as_of: date, days: int = 7, date_from: str | None = None
) -> DataFrame:
    """Enter events per genre, hour and day of the trailing window, or from ``date_from`` on."""
    window = DateWindow.trailing(as_of, first=days, start=date_from)
    return (
        curated.where(window.covers(F.col("dt")))
        .where((F.col("session_action") == "enter") & (F.col("is_cross_partition_date") == F.lit(False)))
        .groupBy(*SLOT, "dt")
        .agg(F.count("*").alias("daily_enter_count"))
    )


def baseline_stats(daily: DataFrame) -> DataFrame:
    """Mean and population deviation over the days present; absent days do not count as zero."""
    n = F.col("daily_enter_count")
    return (
        daily.groupBy(F.coalesce("derived_genre", F.lit(UNKNOWN)).alias("derived_genre"), "hour_of_day_vn")
        .agg(
            four_places(F.avg(n)).alias("rolling_mean"),
            four_places(F.stddev_pop(n)).alias("rolling_std"),
            F.count("*").cast("int").alias("sample_days"),
        )
        .withColumn("genre_hour", F.concat_ws("#", *SLOT))
    )


def baseline(
    curated: DataFrame, as_of: date, days: int = 7, date_from: str | None = None, updated_at: str | None = None
) -> DataFrame:
    stamp = updated_at or f"{as_of.isoformat()}T00:00:00+00:00"
    stats = baseline_stats(daily_enter_counts(curated, as_of, days, date_from))
    return stats.withColumn("updated_at", F.lit(stamp))


def enter_buckets(events: DataFrame, by: list[str | Column] | None = None) -> DataFrame:
    """Enter events per genre and hour, and per ``by`` if given."""
    return (
        events.where(F.col("session_action") == "enter")
        .groupBy(*(by or []), F.coalesce("derived_genre", F.lit(UNKNOWN)).alias("derived_genre"), "hour_of_day_vn")
        .agg(F.count("*").alias("observed_count"))
    )


def silent_buckets(buckets: DataFrame, base: DataFrame, after: datetime | None = None) -> DataFrame:
    """Slots of the baseline without an event, with a count of zero, for every hour that the buckets have closed.

    Those are the hours from the one after ``after``, or the first of the buckets, to their last: hours close in order, so what
    has no bucket by then had no event, be it one genre or all of them. (derived_genre, hour_of_day_vn, observed_count,
    window_start); as many rows at most as slots of the baseline for each day that went by.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    first = F.lit(after).cast("timestamp") + hour if after is not None else F.min("window_start")
    closed = buckets.agg(first.alias("low"), F.max("window_start").alias("high")).where("low <= high")
    hours = closed.select(F.explode(F.sequence("low", "high", hour)).alias("window_start")).withColumn("hour_of_day_vn", local_hour(F.col("window_start")))
    slots = hours.join(base.select(*SLOT).distinct(), "hour_of_day_vn")
    empty = slots.join(buckets.select(*SLOT, "window_start"), [*SLOT, "window_start"], "left_anti")
    return empty.select(*SLOT, F.lit(0).cast("bigint").alias("observed_count"), "window_start")


def baseline_join(buckets: DataFrame, base: DataFrame) -> DataFrame:
    """Add mean and deviation; slots without a baseline get zero for both."""
    right = base.select(*SLOT, F.col("rolling_mean").cast("double"), F.col("rolling_std").cast("double"))
    return buckets.join(right, SLOT, "left").fillna(0.0, ["rolling_mean", "rolling_std"])


def score_buckets(buckets: DataFrame, base: DataFrame, threshold: float = 3.0, std_floor: float = 1.0) -> DataFrame:
    """z-score of each bucket, whether it is an anomaly, and its direction."""
    z = (F.col("observed_count") - F.col("rolling_mean")) / F.greatest("rolling_std", F.lit(std_floor))
    return (
        baseline_join(buckets, base)
        .withColumn("z_score", z)
        .withColumn("is_anomaly", F.abs("z_score") > threshold)
        .withColumn("anomaly_type", F.when(F.col("is_anomaly"), F.when(F.col("z_score") > 0, "SPIKE").otherwise("DROP")))
    )


def score(
    events: DataFrame, base: DataFrame, threshold: float = 3.0, std_floor: float = 1.0, by: list | None = None
) -> DataFrame:
    return score_buckets(enter_buckets(events, by), base, threshold, std_floor)


def anomaly_rows(scored: DataFrame, scope: Column, score_ts: Column) -> DataFrame:
    """Rows of the anomaly table.

    The id is made of genre, hour and ``scope`` (a batch or window), so scoring the same batch
    again gives the same ids. It keeps the whole digest, so two scopes never share one.
    """
    digest = F.sha2(F.concat_ws("|", *SLOT, scope.cast("string")), 256)
    return scored.where("is_anomaly").select(
        F.concat_ws("#", *SLOT, digest).alias("anomaly_id"),
        F.date_format(score_ts, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("score_ts"),
        *SLOT,
        "observed_count",
        four_places(F.col("rolling_mean")).alias("rolling_mean"),
        four_places(F.col("rolling_std")).alias("rolling_std"),
        four_places(F.col("z_score")).alias("z_score"),
        "is_anomaly",
        "anomaly_type",
        (F.unix_timestamp(score_ts) + _TTL_SECONDS).alias("ttl"),
    )


def ttl_filter(anomalies: DataFrame, now: Column) -> DataFrame:
    """Anomalies that have not expired."""
    return anomalies.where(F.col("ttl") > F.unix_timestamp(now))


def alert_events(anomalies: DataFrame) -> DataFrame:
    detail = F.to_json(
        F.struct(*SLOT, "observed_count", F.col("z_score").cast("double").alias("z_score"), "anomaly_type", "anomaly_id")
    )
    return anomalies.select("anomaly_id", F.lit("SearchAnomalyDetected").alias("detail_type"), detail.alias("detail"))


def score_metrics(scored: DataFrame) -> DataFrame:
    """One AnomalyScore point, the absolute z-score, per bucket."""
    dims = F.create_map(F.lit("Genre"), "derived_genre", F.lit("Hour"), F.col("hour_of_day_vn").cast("string"))
    return scored.select(
        F.lit("AnomalyScore").alias("metric_name"),
        dims.alias("dimensions"),
        F.abs("z_score").alias("value"),
        F.lit("None").alias("unit"),
    )


def throughput_counts(events: DataFrame, by: list | None = None) -> DataFrame:
    """Enter and quit events per genre and platform."""
    keys = [
        F.coalesce("derived_genre", F.lit(UNKNOWN)).alias("derived_genre"),
        F.coalesce("platform_group", F.lit("Unknown")).alias("platform_group"),
    ]
    action = F.col("session_action")
    return (
        events.where(action.isin("enter", "quit"))
        .groupBy(*(by or []), *keys)
        .agg(
            F.count_if(action == "enter").alias("SearchEnterEventsPerMinute"),
            F.count_if(action == "quit").alias("SearchQuitEventsPerMinute"),
        )
    )


def throughput_metrics(events: DataFrame) -> DataFrame:
    """The counts as metric points; a point exists only where something was counted."""
    points = throughput_counts(events).unpivot(
        ["derived_genre", "platform_group"],
        ["SearchEnterEventsPerMinute", "SearchQuitEventsPerMinute"],
        "metric_name",
        "value",
    )
    dims = F.create_map(F.lit("Genre"), "derived_genre", F.lit("PlatformGroup"), "platform_group")
    return points.where("value > 0").select(
        "metric_name", dims.alias("dimensions"), F.col("value").cast("double").alias("value"), F.lit("Count").alias("unit")
    )


def anomaly_breakdown(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("anomaly_type").agg(F.count("*").alias("anomalies"))


def anomaly_timeline(anomalies: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Anomalies in time order with the two reference lines of the chart."""
    return anomalies.select(
        "anomaly_id", *SLOT, "z_score", "anomaly_type", "observed_count", "score_ts",
        F.lit(threshold).alias("upper_line"), F.lit(-threshold).alias("lower_line"),
    ).orderBy("score_ts", "anomaly_id")
