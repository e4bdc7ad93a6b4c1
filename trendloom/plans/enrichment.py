"""Raw events to the curated table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions import devices, timestamps
from trendloom.functions.text import keyword_norm
from trendloom.operators.classification import (
    Labeller,
    classify_keywords,
    distinct_keywords,
    lut_unknown_fallback,
    new_keywords_anti,
    with_genre,
)
from trendloom.operators.labelling import AnswerLedger, Provider, label_residual, parse_answers
from trendloom.operators.sessions import with_repeat_flag
from trendloom.schemas import CURATED
from trendloom.session import stage
from trendloom.sources.lookups import load_lookup, update_lookup
from trendloom.sources.raw_events import DateWindow

SESSION = "_session_key"
# The raw columns that the curated table is made of, beside the time.
_READ = ["eventid", "user_id", "keyword", "category", "proxy_isp", "platform", "networktype", "userplansmap", "dt"]


def _parsed() -> Column:
    return timestamps.parse_event_ts(timestamps.clean_datetime(F.col("datetime")))


def repaired(raw: DataFrame) -> DataFrame:
    """Parse the timestamps and drop rows whose year is corrupt or unknown."""
    return raw.withColumn("event_ts", _parsed()).where(timestamps.plausible_year(F.col("event_ts")))


def repaired_once(raw: DataFrame) -> DataFrame:
    """:func:`repaired` with the columns the curated table needs, written to the shared folder.

    Catalyst copies the parser into every filter on the time, and the generated method that holds several copies beside all
    row columns grows past the 8,000 bytes of bytecode up to which the JVM compiles. Here each row is parsed once, and years are tested on what was written. Times are
    written as microseconds, which corrupt years have too whatever the session's calendar settings.
    """
    micros = stage(raw.select(*_READ, F.unix_micros(_parsed()).alias("_micros")), "parsed")
    rows = micros.select(*_READ, F.timestamp_micros("_micros").alias("event_ts"))
    return rows.where(timestamps.plausible_year(F.col("event_ts")))


def row_columns(df: DataFrame) -> DataFrame:
    """All curated columns that depend on one row only. Names that several tests look at are trimmed once, below them."""
    user, isp, platform = F.col("user_id"), F.col("proxy_isp"), F.col("platform")
    trimmed = {"_platform": devices.platform_name(platform), "_network": devices.network_name(F.col("networktype"))}
    return df.withColumns(trimmed).select(
        F.col("eventid").alias("event_id"),
        "event_ts",
        timestamps.local_hour(F.col("event_ts")).alias("hour_of_day_vn"),
        devices.user_id_hashed(user).alias("user_id_hashed"),
        user.isNotNull().alias("user_is_authenticated"),
        F.col("category").alias("session_action"),
        (F.col("category") == "quit").alias("is_search_abandoned"),
        keyword_norm(F.col("keyword")).alias("keyword_norm"),
        F.col("keyword").isNull().alias("keyword_is_null"),
        devices.group_of_platform(F.col("_platform")).alias("platform_group"),
        devices.type_of_network(F.col("_network")).alias("network_type_norm"),
        F.upper(isp).alias("isp_segment"),
        devices.has_premium(F.col("userplansmap")).alias("has_premium"),
        devices.subscription_count(F.col("userplansmap")).alias("subscription_count"),
        devices.session_key(user, isp, platform, F.col("event_ts")).alias(SESSION),
        timestamps.cross_partition_date(F.col("event_ts"), F.col("dt")).alias("is_cross_partition_date"),
        "dt",
    )


def _asked(
    labels: DataFrame, lut_ext: DataFrame | None, provider: Provider, limit: int | None, ledger: AnswerLedger | None = None
) -> DataFrame:
    """(keyword, genre) that the provider gives for the open keywords not in ``lut_ext``; asked once, then read back."""
    counted = labels.where("derived_genre = 'UNKNOWN'")
    if lut_ext is not None:
        counted = new_keywords_anti(counted, lut_ext)
    if limit is not None:
        counted = counted.orderBy(F.desc("n"), "keyword_norm").limit(limit)
    if ledger:
        answers = parse_answers(ledger.run(counted, provider).where(F.col("error").isNull())).where(F.col("genre") != UNKNOWN)
    else:
        answers = label_residual(counted, provider)
    return stage(answers.withColumnRenamed("keyword_norm", "keyword"), "answers")


def learn_labels(
    raw: DataFrame,
    lut: DataFrame,
    ext_root: str,
    label_provider: Provider,
    window: DateWindow | None = None,
    label_limit: int | None = None,
    ledger: AnswerLedger | None = None,
) -> DataFrame:
    """Ask about the open keywords of ``raw`` and publish the answers as a new version of the extended lookup.

    With a ``ledger``, groups of earlier runs that failed are put again too, and what becomes of each is kept there.
    Returns the answers (keyword, genre). Keywords that the lookup under ``ext_root`` holds already are not asked
    again, so the same log asks nothing the second time, and no version is written then.
    """
    if window:
        raw = raw.where(window.covers(F.col("dt")))
    lut_ext = load_lookup(raw.sparkSession, ext_root)
    labels = stage(classify_keywords(distinct_keywords(row_columns(repaired(raw))), lut, lut_ext), "labels")
    answers = _asked(labels, lut_ext, label_provider, label_limit, ledger)
    if not answers.isEmpty():
        update_lookup(answers, ext_root)
    return answers


def curate(
    raw: DataFrame,
    lut: DataFrame,
    lut_ext: DataFrame | None = None,
    window: DateWindow | None = None,
    label_provider: Provider | None = None,
    fuzzy: bool = True,
    fuzzy_ext: bool = False,
    model: Labeller | None = None,
    null_sessions: str = "shared",
    label_limit: int | None = None,
) -> DataFrame:
    """The curated table of ``raw``.

    The raw rows are parsed once and written, as three branches read them (see :func:`repaired_once`). Keywords are classified once each. Their labels are written to the shared folder, which
    the join back to the events reads twice: for its hot keys and for the labels themselves.
    ``label_provider`` is asked about the keywords left UNKNOWN that the extended lookup does not hold, all of
    them or the ``label_limit`` most frequent. Sessions are sorted by the short readable key; the hash comes
    after. They come before the genres, so that the slices of shared sessions read the parsed rows and
    nothing that took a shuffle to make. To keep what the provider answers, see ``learn_labels``.
    """
    if window:
        raw = raw.where(window.covers(F.col("dt")))
    rows = row_columns(repaired_once(raw))
    labels = stage(
        classify_keywords(distinct_keywords(rows), lut, lut_ext, fuzzy, fuzzy_ext, model), "labels"
    )
    if label_provider:
        extra = _asked(labels, lut_ext, label_provider, label_limit).select("keyword", "genre")
        if lut_ext is not None:
            extra = lut_ext.select("keyword", "genre").unionByName(extra)
        labels = stage(lut_unknown_fallback(labels, extra), "labels")
    curated = with_repeat_flag(rows, F.col(SESSION), null_sessions)
    curated = with_genre(curated, labels)
    return curated.withColumn("search_session_id", F.sha2(SESSION, 256)).select(*CURATED.names)
