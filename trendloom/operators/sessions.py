"""Repeat searches within a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Stands for the null session key; no real key is a single NUL.
_NO_SESSION = "\x00"


def with_repeat_flag(
    df: DataFrame,
    key: Column | None = None,
    null_sessions: str = "shared",
    shared: Column | None = None,
    slice_seconds: int = 10,
) -> DataFrame:
    """Add ``is_repeat_search``: the keyword equals the last non-null one before it in the session.

    Null for a null keyword and for a session's first keyword. Ties in ``event_ts`` are broken
    by ``event_id``. Events without a session key share one session (``null_sessions="shared"``)
    or stand alone (``"isolated"``).

    What one user does in a session's half hour is small, but anonymous traffic shares sessions, and events
    without a key share one. Sessions for which ``shared`` holds (by default those of users who are not
    known) are always cut into time slices that are sorted in parallel; each slice starts from the last
    keyword of the slices before it, taken from a table with one row per slice.
    """
    if null_sessions not in ("shared", "isolated"):
        raise ValueError(f"unknown null_sessions {null_sessions!r}")
    key = F.col("search_session_id") if key is None else key
    shared = ~F.col("user_is_authenticated") if shared is None else shared
    lone = F.lit(_NO_SESSION) if null_sessions == "shared" else F.concat(F.lit(_NO_SESSION), F.col("event_id"))
    sliced_by_time = F.floor(F.unix_seconds("event_ts") / slice_seconds)
    sliced = df.withColumn("_session", F.coalesce(key, lone)).withColumn(
        "_slice", F.when(F.coalesce(shared, F.lit(True)) | key.isNull(), sliced_by_time)
    )
    order = ["event_ts", "event_id"]
    before = (
        Window.partitionBy("_session", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    tails = (
        sliced.where(F.col("_slice").isNotNull() & F.col("keyword_norm").isNotNull())
        .groupBy("_session", "_slice")
        .agg(F.max_by("keyword_norm", F.struct(*order)).alias("_tail"))
    )
    carried = tails.select(
        "_session",
        "_slice",
        F.lag("_tail").over(Window.partitionBy("_session").orderBy("_slice")).alias("_carried"),
    )
    last_here = F.last("keyword_norm", ignorenulls=True).over(before)
    return (
        sliced.withColumn("_last_here", last_here)
        .join(carried, ["_session", "_slice"], "left")
        .withColumn("is_repeat_search", F.col("keyword_norm") == F.coalesce("_last_here", "_carried"))
        .drop("_session", "_slice", "_last_here", "_carried")
    )
