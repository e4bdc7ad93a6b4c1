"""All registered queries."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.fixtures import tables as t
from trendloom.functions import devices, genres, text, timestamps
from trendloom.operators import (
    alarms,
    anomalies,
    classification,
    curation,
    evaluation,
    governance,
    labelling,
    replay,
    reports,
    similarity,
    skew,
    trends,
)
from trendloom.operators.sessions import with_repeat_flag
from trendloom.plans import enrichment
from trendloom.registry import oracles as o
from trendloom.registry.base import ORACLES, QUERIES, query
from trendloom.schemas import GENRES, PLATFORMS, RAW_DATA
from trendloom.session import stage, staging_path
from trendloom.sources import lookups, raw_events, sinks
from trendloom.streaming import jobs

__all__ = ["ORACLES", "QUERIES"]
c = F.col
LAST_WEEK = raw_events.DateWindow.trailing(t.AS_OF)
MS = "CAST(epoch_ms(event_ts) AS BIGINT)"


def _as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def _parsed(spark, sf) -> DataFrame:
    return enrichment.repaired(t.search_log(spark, sf))


# ---- scans and sinks ------------------------------------------------------------------------------

_RAW_COLUMNS = "eventid, datetime, user_id, keyword, category, proxy_isp, platform, networktype, action"
_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def _raw_table(spark, sf) -> str:
    """The raw layer under its partition keys: day and platform as they are; hour and genre of one kind keep the folders few."""
    path = staging_path(spark, "raw")
    rows = t.search_log(spark, sf).withColumns(
        {"hour": F.lit("all"), "derived_genre": F.lit("ALL"), "platform_group": devices.platform_group(c("platform"))}
    )
    rows.repartition("dt").write.partitionBy("dt", "hour", "derived_genre", "platform_group").parquet(path)
    return path


@query(
    "scan_raw_events",
    f"""SELECT {_RAW_COLUMNS}, array_to_string(userplansmap, ';') AS plans, dt, 'all' AS hour, 'ALL' AS derived_genre,
          {o._platform('platform')} AS platform_group FROM search_log""",
)
def scan_raw_events(spark, sf):
    rows = raw_events.scan_raw_events(spark, _raw_table(spark, sf))
    keys = [F.nullif(k, F.lit(_HIVE_NULL)).alias(k) for k in ("dt", "hour", "derived_genre", "platform_group")]
    return rows.select(*_RAW_COLUMNS.split(", "), F.array_join("userplansmap", ";").alias("plans"), *keys)


@query("scan_date_window", "SELECT eventid, dt FROM search_log WHERE dt BETWEEN '2024-01-24' AND '2024-01-30'")
def scan_date_window(spark, sf):
    return raw_events.scan_raw_events(spark, _raw_table(spark, sf), LAST_WEEK).select("eventid", "dt")


@query("scan_source_files", f"SELECT {_RAW_COLUMNS} FROM search_log")
def scan_source_files(spark, sf):
    path = staging_path(spark, "files")
    t.search_log(spark, sf).write.parquet(f"{path}/a/b")
    return raw_events.scan_source_files(spark, path, RAW_DATA).select(*_RAW_COLUMNS.split(", "))


@query(
    "file_modal_date",
    """SELECT platform, modal_date FROM (SELECT platform, replace(left(datetime, 10), '-', '') AS modal_date,
         row_number() OVER (PARTITION BY platform ORDER BY count(*) DESC, replace(left(datetime, 10), '-', '')) AS rn
       FROM search_log WHERE length(datetime) >= 10 GROUP BY platform, replace(left(datetime, 10), '-', '')) WHERE rn = 1""",
)
def file_modal_date(spark, sf):
    return raw_events.file_modal_date(t.search_log(spark, sf), "platform")


def _encoded(spark, sf, extras=None) -> DataFrame:
    """Events as a stream carries them: base64 JSON, some records damaged."""
    event = F.to_json(F.struct(*RAW_DATA.names, *[x.alias(name) for name, x in (extras or {}).items()]))
    damaged = F.pmod(c("eventid").cast("bigint"), F.lit(17)) == 0
    sent = F.when(damaged, F.left(event, F.lit(9))).otherwise(event)
    return t.search_log(spark, sf).select(F.base64(F.encode(sent, "utf-8")).alias("data"))


@query("decode_json_records", f"SELECT {_RAW_COLUMNS}, false AS dead FROM search_log WHERE CAST(eventid AS BIGINT) % 17 <> 0 "
       "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM search_log WHERE CAST(eventid AS BIGINT) % 17 = 0")
def decode_json_records(spark, sf):
    good, dead = raw_events.decode_json_records(_encoded(spark, sf))
    good = good.select(*_RAW_COLUMNS.split(", "), F.lit(False).alias("dead"))
    return good.unionByName(dead.select(F.lit(True).alias("dead")), allowMissingColumns=True)


_CURATED_SQL = f"SELECT event_id, {MS} AS event_ts, * EXCLUDE (event_id, event_ts) FROM curated"


@query("curated_sink", _CURATED_SQL)
def curated_sink(spark, sf):
    path = staging_path(spark, "curated-table")
    for _ in range(2):
        sinks.write_curated(t.curated(spark, sf), path)
    back = spark.read.schema(t.curated(spark, sf).schema).parquet(path)
    return back.withColumn("dt", F.nullif("dt", F.lit("__HIVE_DEFAULT_PARTITION__")))


_GOLD_SQL = """SELECT derived_genre, platform_group, network_type_norm, isp_segment, keyword_norm, search_count, enter_count,
  round(abandonment_rate, 6) AS abandonment_rate, unique_users, round(authenticated_rate, 6) AS authenticated_rate,
  round(repeat_search_rate, 6) AS repeat_search_rate, round(premium_search_rate, 6) AS premium_search_rate,
  rank_today, rank_7d_ago, rank_delta, CAST(trend_date AS VARCHAR) AS trend_date FROM gold"""


@query("gold_sink", _GOLD_SQL)
def gold_sink(spark, sf):
    path = staging_path(spark, "gold-table")
    for side in ("upto", "after", "upto", "after"):
        sinks.write_gold(t.gold(spark, sf), path, split_date="2024-01-15", side=side)
    return spark.read.schema(t.gold(spark, sf).schema).parquet(path)


@query("load_lookup", "SELECT keyword, genre FROM lut_ext")
def load_lookup(spark, sf):
    root = staging_path(spark, "lookup")
    lookups.write_lookup(t.lut_ext(spark, sf), root)
    return lookups.load_lookup(spark, root).select("keyword", "genre")


@query(
    "merge_lookup",
    """SELECT keyword, coalesce(u.genre, e.genre) AS genre FROM (SELECT keyword, genre FROM lut_ext) e
       FULL JOIN (SELECT keyword_norm AS keyword, oracle_genre AS genre FROM compared) u USING (keyword)
       WHERE coalesce(u.genre, e.genre) <> 'UNKNOWN'""",
)
def merge_lookup(spark, sf):
    updates = t.compared(spark, sf).select(c("keyword_norm").alias("keyword"), c("oracle_genre").alias("genre"))
    return lookups.merge_lookup(t.lut_ext(spark, sf), updates)


@query(
    "read_keyword_csv",
    """SELECT regexp_replace(trim(keyword_norm, chr(32) || chr(10)), '^"+|"+$', '', 'g') AS keyword_norm FROM keyword_pool p
       WHERE NOT EXISTS (SELECT 1 FROM lut_ext e WHERE e.keyword = trim(p.keyword_norm, chr(32) || chr(10)))""",
)
def read_keyword_csv(spark, sf):
    path = staging_path(spark, "csv")
    t.keyword_pool(spark, sf).select("keyword_norm").write.option("header", "true").option("escape", '"').csv(path)
    return lookups.read_keyword_csv(spark, path, t.lut_ext(spark, sf), multi_line=True)


_BASE = "round(rolling_mean, 6) AS rolling_mean, round(rolling_std, 6) AS rolling_std, sample_days"


@query(
    "baseline_upsert",
    f"""SELECT coalesce(n.genre_hour, b.genre_hour) AS genre_hour, round(coalesce(n.rolling_mean, b.rolling_mean), 6) AS rolling_mean,
          coalesce(n.sample_days, b.sample_days) AS sample_days,
          CASE WHEN n.genre_hour IS NULL THEN '2024-01-31T00:00:00+00:00' ELSE '2024-02-01T00:00:00+00:00' END AS updated_at
        FROM (SELECT genre_hour, rolling_mean, sample_days FROM baseline) b FULL JOIN (
          SELECT derived_genre || '#' || hour_of_day_vn AS genre_hour, round(avg(d), 4) AS rolling_mean, count(*) AS sample_days
          FROM (SELECT derived_genre, hour_of_day_vn, dt, count(*) AS d FROM curated WHERE dt >= '2024-01-29'
                AND session_action = 'enter' AND is_cross_partition_date = false GROUP BY ALL) GROUP BY ALL) n USING (genre_hour)""",
)
def baseline_upsert(spark, sf):
    fresh = anomalies.baseline(
        t.curated(spark, sf), t.AS_OF, date_from="2024-01-29", updated_at="2024-02-01T00:00:00+00:00"
    )
    merged = sinks.upsert_baseline(t.baseline(spark, sf), fresh)
    return merged.select("genre_hour", "rolling_mean", "sample_days", "updated_at")


def _scored(spark, sf) -> DataFrame:
    return anomalies.score(t.curated(spark, sf), t.baseline(spark, sf), by=["dt"])


def _anomalies(spark, sf) -> DataFrame:
    return anomalies.anomaly_rows(_scored(spark, sf), F.coalesce("dt", F.lit("none")), _as_of())


_ANOMALY_SQL = """SELECT anomaly_id, score_ts, derived_genre, hour_of_day_vn, observed_count, round(rolling_mean, 6) AS rolling_mean,
  round(rolling_std, 6) AS rolling_std, round(z_score, 6) AS z_score, is_anomaly, anomaly_type, CAST(ttl AS BIGINT) AS ttl FROM anomalies"""


@query("anomaly_append", _ANOMALY_SQL)
def anomaly_append(spark, sf):
    path = staging_path(spark, "anomalies")
    rows = _anomalies(spark, sf)
    for _ in range(2):
        sinks.append_anomalies(rows, path)
    return sinks.read_anomalies(spark, path, rows.schema)


@query("report_sink", "SELECT keyword_norm, rules_genre, oracle_genre, agree, search_count FROM compared")
def report_sink(spark, sf):
    path = staging_path(spark, "report")
    rows = t.compared(spark, sf)
    sinks.write_report(rows, path)
    return spark.read.schema(rows.schema).option("header", "true").csv(path)


@query(
    "register_partitions",
    "SELECT 0 AS rows_before, count(*) AS rows_after, count(DISTINCT (coalesce(dt, 'none'), derived_genre)) AS partitions FROM curated",
)
def register_partitions(spark, sf):
    """Rows of a catalog table over the curated files, before and after its partitions are registered."""
    path, table = staging_path(spark, "registered"), f"curated_{uuid.uuid4().hex}"
    curated = t.curated(spark, sf)
    sinks.write_curated(curated, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in curated.schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (dt, derived_genre) LOCATION '{path}'")
    before = spark.table(table).count()
    sinks.register_partitions(spark, table)
    partitions = spark.sql(f"SHOW PARTITIONS {table}").count()
    after = spark.table(table).count()
    spark.sql(f"DROP TABLE {table}")
    return spark.range(1).select(F.lit(before).alias("rows_before"), F.lit(after).alias("rows_after"), F.lit(partitions).alias("partitions"))


# ---- scalar functions -----------------------------------------------------------------------------


def _scalar(name: str, column, sql_expr: str, sql_from: str = "repaired", make=_parsed) -> None:
    @query(name, f"SELECT eventid AS event_id, {sql_expr} AS {name} FROM {sql_from}")
    def run(spark, sf):
        return make(spark, sf).select(c("eventid").alias("event_id"), column().alias(name))


_padded = f"rpad({o._clean('datetime')}, 23, '0')"
_scalar("clean_datetime", lambda: F.rpad(timestamps.clean_datetime(c("datetime")), 23, "0"), _padded, "search_log", t.search_log)
_scalar(
    "parse_event_ts", lambda: timestamps.parse_event_ts(timestamps.clean_datetime(c("datetime"))), MS, "parsed", t.search_log
)
_scalar("hour_of_day_vn", lambda: timestamps.local_hour(c("event_ts")), "CAST(hour(event_ts + INTERVAL 7 HOUR) AS BIGINT)")
_scalar("session_action", lambda: c("category"), "category")
_scalar("is_search_abandoned", lambda: c("category") == "quit", "category = 'quit'")
_scalar("user_is_authenticated", lambda: c("user_id").isNotNull(), "user_id IS NOT NULL")
_scalar("user_id_hashed", lambda: devices.user_id_hashed(c("user_id")), "sha256(user_id)")
_scalar("keyword_norm", lambda: text.keyword_norm(c("keyword")), "lower(trim(keyword))")
_scalar("stream_keyword_norm", lambda: text.stream_keyword_norm(c("keyword")), f"nullif({o._strip('lower(keyword)')}, '')")
_scalar("keyword_is_null", lambda: c("keyword").isNull(), "keyword IS NULL")
_scalar("platform_group", lambda: devices.platform_group(c("platform")), o._platform("platform"))
_scalar("network_type_norm", lambda: devices.network_type_norm(c("networktype")), o._network("networktype"))
_scalar("isp_segment", lambda: F.upper("proxy_isp"), "upper(proxy_isp)")
_scalar("has_premium", lambda: devices.has_premium(c("userplansmap")), o._premium("userplansmap"))
_scalar("subscription_count", lambda: devices.subscription_count(c("userplansmap")), "CAST(len(userplansmap) AS BIGINT)")
_scalar(
    "search_session_id",
    lambda: devices.search_session_id(c("user_id"), c("proxy_isp"), c("platform"), c("event_ts")),
    "sha256(CASE WHEN user_id IS NOT NULL THEN user_id || '|' || CAST(CAST(floor(epoch(event_ts) / 1800) AS BIGINT) AS VARCHAR) "
    "ELSE proxy_isp || '|' || platform || '|' || CAST(CAST(floor(epoch(event_ts) / 1800) AS BIGINT) AS VARCHAR) END)",
)
_scalar(
    "is_cross_partition_date",
    lambda: timestamps.cross_partition_date(c("event_ts"), c("dt")),
    "year(event_ts) <> try_cast(substr(dt, 1, 4) AS INT)",
)


def _keyword_scalar(name: str, column, sql_expr: str) -> None:
    @query(name, f"SELECT keyword_norm, {sql_expr} AS {name} FROM keyword_pool")
    def run(spark, sf):
        return t.keyword_pool(spark, sf).select("keyword_norm", column().alias(name))


_keyword_scalar("preprocess_keyword", lambda: text.preprocess_keyword(c("keyword_norm")), o._preprocess("keyword_norm"))
_keyword_scalar("strip_diacritics", lambda: text.strip_diacritics(c("keyword_norm")), "strip_accents(keyword_norm)")
_keyword_scalar(
    "sanitize_keyword",
    lambda: text.sanitize_keyword(c("keyword_norm")),
    o._strip("regexp_replace(keyword_norm, '[\\x00-\\x1f\\x7f\\\\]', ' ', 'g')"),
)
_SPELLINGS = "kdrama| K-POP |hoat_hinh|ANIME|nothing|phim_le|Show|the_thao|"
_keyword_scalar(
    "normalize_genre",
    lambda: text.normalize_genre(F.split_part(F.lit(_SPELLINGS), F.lit("|"), (F.length("keyword_norm") % 9 + 1).cast("int"))),
    o._normalize(f"split_part('{_SPELLINGS}', '|', CAST(length(keyword_norm) % 9 AS INT) + 1)"),
)


# ---- replay ---------------------------------------------------------------------------------------

_ORDERED = """SELECT event_id, dt, derived_genre, row_number() OVER (PARTITION BY dt ORDER BY event_ts, event_id) AS rn FROM curated"""


def _ordered(spark, sf) -> DataFrame:
    return replay.replay_order(t.curated(spark, sf), file_col="dt")


@query(
    "replay_order",
    """SELECT eventid AS event_id, platform, rn, CAST(floor((rn - 1) / 500) AS BIGINT) AS batch_id FROM (
         SELECT eventid, platform, row_number() OVER (PARTITION BY platform ORDER BY coalesce(epoch_us(event_ts), 0), eventid) AS rn FROM parsed)""",
)
def replay_order(spark, sf):
    parsed = t.search_log(spark, sf).select(
        c("eventid").alias("event_id"),
        "platform",
        timestamps.parse_event_ts(timestamps.clean_datetime(c("datetime"))).alias("event_ts"),
    )
    return replay.replay_order(parsed, file_col="platform").select("event_id", "platform", "rn", "batch_id")


@query("salted_partition_key", f"SELECT event_id, derived_genre || '_' || ((rn - 1) % 500 % 100) AS partition_key FROM ({_ORDERED})")
def salted_partition_key(spark, sf):
    key = replay.salted_partition_key(c("derived_genre"), c("rn"))
    return _ordered(spark, sf).select("event_id", key.alias("partition_key"))


@query(
    "inject_anomaly",
    """SELECT event_id, derived_genre, hour_of_day_vn FROM curated UNION ALL
       SELECT event_id, derived_genre, hour_of_day_vn FROM curated, range(1, 10) r WHERE derived_genre = 'THE_THAO' AND hour_of_day_vn = 20""",
)
def inject_anomaly(spark, sf):
    return replay.inject_anomaly(t.curated(spark, sf).select("event_id", "derived_genre", "hour_of_day_vn"))


# ---- filters --------------------------------------------------------------------------------------


@query("drop_corrupt_year", f"SELECT eventid, {MS} AS event_ts FROM repaired")
def drop_corrupt_year(spark, sf):
    return _parsed(spark, sf).select("eventid", "event_ts")


@query("gold_valid_rows", "SELECT event_id, keyword_norm FROM valid")
def gold_valid_rows(spark, sf):
    return trends.valid_rows(t.curated(spark, sf)).select("event_id", "keyword_norm")


for _action in ("enter", "quit"):

    @query(f"{_action}_events", f"SELECT event_id FROM curated WHERE session_action = '{_action}'")
    def action_events(spark, sf, action=_action):
        return t.curated(spark, sf).where(c("session_action") == action).select("event_id")


@query("trailing_window", "SELECT event_id, dt FROM curated WHERE dt BETWEEN '2024-01-24' AND '2024-01-30'")
def trailing_window(spark, sf):
    return t.curated(spark, sf).where(LAST_WEEK.covers(c("dt"))).select("event_id", "dt")


@query("ttl_filter", "SELECT anomaly_id FROM anomalies WHERE ttl > 1706659200 + 86400")
def ttl_filter(spark, sf):
    return anomalies.ttl_filter(_anomalies(spark, sf), _as_of() + F.expr("INTERVAL 1 DAY")).select("anomaly_id")


# ---- joins and classification ---------------------------------------------------------------------


def _pool_forms(spark, sf) -> DataFrame:
    return t.keyword_pool(spark, sf).select("keyword_norm", text.preprocess_keyword(c("keyword_norm")).alias("kw"))


_FORMS = f"(SELECT keyword_norm, {o._preprocess('keyword_norm')} AS kw FROM keyword_pool)"


@query(
    "lut_exact_join",
    f"""SELECT f.keyword_norm, coalesce(l.genre, e.genre) AS genre FROM {_FORMS} f
        LEFT JOIN lut l ON l.keyword = f.kw LEFT JOIN lut_ext e ON e.keyword = f.kw""",
)
def lut_exact_join(spark, sf):
    df = classification.lut_exact_join(_pool_forms(spark, sf), t.lut(spark, sf), "a")
    df = classification.lut_exact_join(df, t.lut_ext(spark, sf), "b")
    return df.select("keyword_norm", F.coalesce("a", "b").alias("genre"))


@query(
    "lut_nodiac_join",
    f"""SELECT f.keyword_norm, n.genre FROM (SELECT keyword_norm, strip_accents(kw) AS plain FROM {_FORMS}) f LEFT JOIN (
          SELECT strip_accents(keyword) AS plain, arg_max(genre, ordinal) AS genre FROM lut_ext GROUP BY 1) n USING (plain)""",
)
def lut_nodiac_join(spark, sf):
    df = classification.lut_nodiac_join(_pool_forms(spark, sf), t.lut_ext(spark, sf), "genre")
    return df.select("keyword_norm", "genre")


@query(
    "lut_unknown_fallback",
    """SELECT event_id, CASE WHEN c.derived_genre = 'UNKNOWN' AND c.keyword_norm IS NOT NULL THEN coalesce(e.genre, 'UNKNOWN')
         ELSE c.derived_genre END AS derived_genre FROM curated c LEFT JOIN lut_ext e ON e.keyword = c.keyword_norm""",
)
def lut_unknown_fallback(spark, sf):
    df = classification.lut_unknown_fallback(t.curated(spark, sf), t.lut_ext(spark, sf))
    return df.select("event_id", "derived_genre")


@query(
    "new_keywords_anti",
    "SELECT keyword_norm FROM keyword_pool WHERE keyword_norm NOT IN (SELECT keyword FROM lut_ext)",
)
def new_keywords_anti(spark, sf):
    return classification.new_keywords_anti(t.keyword_pool(spark, sf), t.lut_ext(spark, sf)).select("keyword_norm")


@query(
    "rank_history_join",
    f"""SELECT keyword_norm, {o._SLOT}, CAST(trend_date AS VARCHAR) AS trend_date, network_type_norm, isp_segment, rank_today,
          coalesce(rank_7d_ago, 9999) AS rank_7d_ago, coalesce(rank_7d_ago, 9999) - rank_today AS rank_delta
        FROM ranked_today LEFT JOIN (SELECT {o._SLOT}, keyword_norm, rank_7d_ago FROM ranked_7d) h USING ({o._SLOT}, keyword_norm)""",
)
def rank_history_join(spark, sf):
    history = trends.rank_history(t.curated(spark, sf), t.AS_OF)
    joined = trends.with_rank_history(_ranked_today(spark, sf), history)
    return joined.select(
        "keyword_norm", "derived_genre", "platform_group", "trend_date", "network_type_norm", "isp_segment",
        "rank_today", "rank_7d_ago", "rank_delta",
    )


@query(
    "baseline_join",
    """SELECT dt, derived_genre, hour_of_day_vn, observed_count, round(rolling_mean, 6) AS rolling_mean,
         round(rolling_std, 6) AS rolling_std FROM scored""",
)
def baseline_join(spark, sf):
    return anomalies.baseline_join(anomalies.enter_buckets(t.curated(spark, sf), ["dt"]), t.baseline(spark, sf))


@query(
    "token_subset_join",
    f"""SELECT kw, arg_min(key, ordinal) AS key, arg_min(genre, ordinal) AS genre FROM
          (SELECT kw, {o._tokens('kw')} AS qt FROM (SELECT DISTINCT kw FROM {_FORMS})) q,
          (SELECT keyword AS key, genre, ordinal, {o._tokens('keyword')} AS kt FROM
             (SELECT keyword, genre, ordinal FROM lut UNION ALL SELECT keyword, genre, 1000 + ordinal FROM lut_ext)) k
        WHERE len(qt) > 0 AND len(kt) > 0 AND (list_has_all(kt, qt) OR list_has_all(qt, kt)) GROUP BY kw""",
)
def token_subset_join(spark, sf):
    both = t.lut(spark, sf).unionByName(t.lut_ext(spark, sf).withColumn("ordinal", c("ordinal") + 1000))
    return similarity.token_subset_join(_pool_forms(spark, sf), both).select("kw", "key", "genre")


def _fuzzy_sql(lookup: str, where: str, cutoff: int) -> str:
    """Brute force over all pairs; the subsequence table is only filled for pairs of near lengths."""
    share = f"{(100 - cutoff) / 100}"
    lcs = (
        "list_last(list_reduce(string_split(y, ''), lambda acc, ch: " + o._indel_columns("x", "y") +
        ", list_transform(range(1, length(x) + 1), lambda i: 0)))"
    )
    toks_q, toks_k = o._tokens("kw"), o._tokens("keyword")
    return f"""SELECT kw, arg_max(key, (score, -ordinal)) AS key, arg_max(genre, (score, -ordinal)) AS genre, round(max(score), 6) AS score FROM (
      SELECT kw, key, genre, ordinal, greatest(plain, CASE WHEN d IS NULL THEN 0 ELSE 100 - 100 * d / CAST(total AS DOUBLE) END) AS score FROM (
        SELECT *, CASE WHEN plain < 100 AND abs(length(x) - length(y)) <= total * {share} + 1e-9 AND levenshtein(x, y) <= total * {share} + 1e-9
            THEN length(x) + length(y) - 2 * {lcs} END AS d FROM (
          SELECT *, 2 * (s + CASE WHEN s > 0 THEN 1 ELSE 0 END) + length(x) + length(y) AS total,
            CASE WHEN s > 0 AND (x = '' OR y = '') THEN 100.0 WHEN s > 0 THEN greatest(
              100 - 100 * (1 + length(x)) / CAST(2 * s + 1 + length(x) AS DOUBLE), 100 - 100 * (1 + length(y)) / CAST(2 * s + 1 + length(y) AS DOUBLE))
            ELSE 0 END AS plain FROM (
            SELECT kw, key, genre, ordinal, length(array_to_string(list_intersect(qt, kt), ' ')) AS s,
              array_to_string(list_sort(list_filter(qt, lambda e: NOT list_contains(kt, e))), ' ') AS x,
              array_to_string(list_sort(list_filter(kt, lambda e: NOT list_contains(qt, e))), ' ') AS y
            FROM (SELECT kw, {toks_q} AS qt FROM (SELECT DISTINCT kw FROM {_FORMS} WHERE {where.replace('keyword', 'kw')})) q,
                 (SELECT keyword AS key, genre, ordinal, {toks_k} AS kt FROM {lookup}) k WHERE len(qt) > 0 AND len(kt) > 0)))
    ) WHERE score >= {cutoff} GROUP BY kw"""


@query("fuzzy_lut_join", _fuzzy_sql("lut", "length(keyword) >= 4", 85))
def fuzzy_lut_join(spark, sf):
    return similarity.fuzzy_join(_pool_forms(spark, sf), t.lut(spark, sf)).select("kw", "key", "genre", "score")


_PHRASE = "length(keyword) >= 8 AND contains(keyword, ' ')"


@query(
    "fuzzy_lut_ext_join",
    _fuzzy_sql(f"(SELECT keyword, genre, ordinal FROM lut_ext WHERE {_PHRASE})", _PHRASE, 92),
)
def fuzzy_lut_ext_join(spark, sf):
    return similarity.fuzzy_ext_join(_pool_forms(spark, sf), t.lut_ext(spark, sf)).select("kw", "key", "genre", "score")


@query("regex_genre", f"SELECT keyword_norm, {o._regex_genre('keyword_norm')} AS genre FROM keyword_pool")
def regex_genre(spark, sf):
    return t.keyword_pool(spark, sf).select("keyword_norm", genres.regex_genre(c("keyword_norm")).alias("genre"))


@query(
    "classify_rules",
    f"""SELECT f.keyword_norm, CASE WHEN kw = '' THEN 'UNKNOWN' ELSE coalesce(l.genre, e.genre, n.genre, {o._regex_genre('kw')}) END AS genre,
          CASE WHEN kw = '' THEN 'empty' WHEN l.genre IS NOT NULL THEN 'lut' WHEN e.genre IS NOT NULL THEN 'lut_ext'
               WHEN n.genre IS NOT NULL THEN 'nodiac' WHEN {o._regex_genre('kw')} IS NOT NULL THEN 'regex' END AS stage
        FROM (SELECT *, strip_accents(kw) AS plain FROM {_FORMS}) f
          LEFT JOIN lut l ON l.keyword = f.kw LEFT JOIN lut_ext e ON e.keyword = f.kw
          LEFT JOIN (SELECT strip_accents(keyword) AS plain, arg_max(genre, ordinal) AS genre FROM lut_ext GROUP BY 1) n USING (plain)""",
)
def classify_rules(spark, sf):
    df = classification.rule_stages(t.keyword_pool(spark, sf), t.lut(spark, sf), t.lut_ext(spark, sf))
    return df.select("keyword_norm", "genre", "stage")


_BY_FUZZY = _fuzzy_sql("lut", "length(keyword) >= 4", 85)
_BY_FUZZY_EXT = _fuzzy_sql(f"(SELECT keyword, genre, ordinal FROM lut_ext WHERE {_PHRASE})", _PHRASE, 92)


@query(
    "classify_keywords",
    f"""SELECT r.keyword_norm, coalesce(r.genre, a.genre, b.genre, 'UNKNOWN') AS derived_genre,
          coalesce(r.stage, CASE WHEN a.genre IS NOT NULL THEN 'fuzzy' WHEN b.genre IS NOT NULL THEN 'fuzzy_ext' END, 'none') AS stage
        FROM (SELECT f.keyword_norm, f.kw, CASE WHEN f.kw = '' THEN 'UNKNOWN' ELSE coalesce(l.genre, e.genre, n.genre, {o._regex_genre('f.kw')}) END AS genre,
                CASE WHEN f.kw = '' THEN 'empty' WHEN l.genre IS NOT NULL THEN 'lut' WHEN e.genre IS NOT NULL THEN 'lut_ext'
                  WHEN n.genre IS NOT NULL THEN 'nodiac' WHEN {o._regex_genre('f.kw')} IS NOT NULL THEN 'regex' END AS stage
              FROM (SELECT *, strip_accents(kw) AS plain FROM {_FORMS}) f
                LEFT JOIN lut l ON l.keyword = f.kw LEFT JOIN lut_ext e ON e.keyword = f.kw
                LEFT JOIN (SELECT strip_accents(keyword) AS plain, arg_max(genre, ordinal) AS genre FROM lut_ext GROUP BY 1) n USING (plain)) r
          LEFT JOIN ({_BY_FUZZY}) a USING (kw) LEFT JOIN ({_BY_FUZZY_EXT}) b USING (kw)""",
)
def classify_keywords(spark, sf):
    labelled = classification.classify_keywords(
        t.keyword_pool(spark, sf), t.lut(spark, sf), t.lut_ext(spark, sf), fuzzy=True, fuzzy_ext=True
    )
    return labelled.select("keyword_norm", "derived_genre", "stage")


@query(
    "unknown_top_keywords",
    """SELECT keyword_norm, count(*) AS n FROM curated WHERE derived_genre = 'UNKNOWN' AND keyword_norm IS NOT NULL
       GROUP BY 1 ORDER BY n DESC, keyword_norm LIMIT 2000""",
)
def unknown_top_keywords(spark, sf):
    return classification.unknown_top_keywords(t.curated(spark, sf), 2000)




@query(
    "label_residual",
    f"""SELECT keyword_norm, genre FROM (SELECT keyword_norm, split_part('{'|'.join(GENRES)}', '|', CAST(length(
          {o._strip("regexp_replace(keyword_norm, '[\\x00-\\x1f\\x7f\\\\]', ' ', 'g')")}) % 9 AS INT) + 1) AS genre
        FROM keyword_pool) WHERE genre <> 'UNKNOWN'""",
)
def label_residual(spark, sf):
    genre_of = list(GENRES)

    def provider(keywords: list[str]) -> str:
        answer = {k: genre_of[len(k) % 9] for k in keywords}
        return "```json\n" + json.dumps(answer, ensure_ascii=False) + "\n```"

    return labelling.label_residual(t.keyword_pool(spark, sf), provider)


@query("label_ledger", f"""SELECT keyword_norm, genre, 0 AS open_groups FROM (SELECT keyword_norm, split_part('{'|'.join(GENRES)}', '|', CAST(length(
          {o._strip("regexp_replace(keyword_norm, '[\\x00-\\x1f\\x7f\\\\]', ' ', 'g')")}) % 9 AS INT) + 1) AS genre
        FROM keyword_pool) WHERE genre <> 'UNKNOWN'""")
def label_ledger(spark, sf):
    """The provider fails for a third of the groups in the first run; the second asks these again and no others."""
    genre_of = list(GENRES)

    def sound(keywords: list[str]) -> str:
        return json.dumps({k: genre_of[len(k) % 9] for k in keywords}, ensure_ascii=False)

    def moody(keywords: list[str]) -> str:
        if sum(map(len, keywords)) % 3 == 0:
            raise ConnectionError("not now")
        return sound(keywords)

    ledger = labelling.AnswerLedger(spark, staging_path(spark, "ledger"), batch=20, stop_after=None)
    pool = stage(t.keyword_pool(spark, sf).select("keyword_norm"), "pool")
    for provider in (moody, sound):
        ledger.run(pool, provider)
    return ledger.labels().withColumn("open_groups", F.lit(ledger.open_groups().count()))


_MARK_GENRES = ("NHAC", "ANIME", "PHIM_HAN", "THE_THAO")
_MARKED = f"split_part('{'|'.join(_MARK_GENRES)}', '|', CAST(length(kw) % 4 AS INT) + 1)"


@query("ml_label", f"SELECT repeat('mark' || length(kw) % 4 || ' ', 1 + length(kw) % 5) AS kw, {_MARKED} AS genre FROM {_FORMS}")
def ml_label(spark, sf):
    """Every keyword is turned into words that tell its genre; the model must learn them from the catalogue and apply them."""
    place = (F.length("kw") % 4).cast("int")
    marked = lambda df: df.select(F.repeat(F.concat(F.lit("mark"), place.cast("string"), F.lit(" ")), (1 + F.length("kw") % 5).cast("int")).alias("kw"), F.array(*map(F.lit, _MARK_GENRES))[place].alias("genre"))
    model = labelling.train_ml_labeller(marked(t.lut_ext(spark, sf).select(c("keyword").alias("kw"))))
    return labelling.ml_label(marked(_pool_forms(spark, sf).select("kw")), model)


@query(
    "label_write_back",
    """SELECT k.keyword_norm AS keyword, split_part('NHAC|ANIME', '|', CAST(length(k.keyword_norm) % 2 AS INT) + 1) AS genre, 0 AS asked_again
       FROM (SELECT DISTINCT keyword_norm FROM labels WHERE derived_genre = 'UNKNOWN' AND keyword_norm <> '') k""",
)
def label_write_back(spark, sf):
    """Answers for the open keywords go into the lookup's next version; the second run has nothing to ask."""
    root = staging_path(spark, "learned")

    def provider(keywords: list[str]) -> str:
        return json.dumps({k: ("NHAC", "ANIME")[len(k) % 2] for k in keywords}, ensure_ascii=False)

    asked = [enrichment.learn_labels(t.search_log(spark, sf), t.lut(spark, sf), root, provider).count() for _ in range(2)]
    return lookups.load_lookup(spark, root).select("keyword", "genre", F.lit(asked[1]).alias("asked_again"))


@query(
    "distinct_keywords",
    "SELECT DISTINCT keyword_norm FROM curated WHERE derived_genre = 'UNKNOWN' AND keyword_norm <> ''",
)
def distinct_keywords(spark, sf):
    return classification.distinct_unknown_keywords(t.curated(spark, sf))


# ---- enrichment and gold --------------------------------------------------------------------------


@query("search_enriched", _CURATED_SQL)
def search_enriched(spark, sf):
    return t.fresh_curated(spark, sf)


@query("is_repeat_search", "SELECT event_id, is_repeat_search FROM curated")
def is_repeat_search(spark, sf):
    rows = enrichment.row_columns(_parsed(spark, sf))
    return with_repeat_flag(rows, c(enrichment.SESSION)).select("event_id", "is_repeat_search")


_STATS = """trend_date, derived_genre, platform_group, network_type_norm, isp_segment, keyword_norm, search_count, enter_count,
  round(abandonment_rate, 6) AS abandonment_rate, unique_users, round(authenticated_rate, 6) AS authenticated_rate,
  round(repeat_search_rate, 6) AS repeat_search_rate, round(premium_search_rate, 6) AS premium_search_rate"""


@query("keyword_daily_stats", f"SELECT CAST(trend_date AS VARCHAR) AS {_STATS} FROM daily_stats")
def keyword_daily_stats(spark, sf):
    return trends.keyword_daily_stats(t.curated(spark, sf), t.ALL_DAYS)


@query("enter_counts_7d", "SELECT * FROM counts_7d")
def enter_counts_7d(spark, sf):
    return trends.enter_counts_trailing(t.curated(spark, sf), t.AS_OF)


def _ranked_today(spark, sf) -> DataFrame:
    stats = stage(trends.keyword_daily_stats(t.curated(spark, sf), t.ALL_DAYS), "daily-stats")
    return skew.rank_desc(stats, ["derived_genre", "platform_group"], "enter_count", "rank_today")


@query("rank_today", f"SELECT CAST(trend_date AS VARCHAR) AS {_STATS}, rank_today FROM ranked_today")
def rank_today(spark, sf):
    return _ranked_today(spark, sf)


@query("rank_7d_ago", f"SELECT {o._SLOT}, keyword_norm, rank_7d_ago FROM ranked_7d")
def rank_7d_ago(spark, sf):
    return trends.rank_history(t.curated(spark, sf), t.AS_OF)


@query("gold_keyword_trends", _GOLD_SQL)
def gold_keyword_trends(spark, sf):
    return t.fresh_gold(spark, sf)


@query(
    "gold_rank_by_date",
    f"""SELECT CAST(trend_date AS VARCHAR) AS trend_date, {o._SLOT}, network_type_norm, isp_segment, keyword_norm, rank_today FROM (
          SELECT *, rank() OVER (PARTITION BY trend_date, {o._SLOT} ORDER BY enter_count DESC) AS rank_today FROM daily_stats) WHERE rank_today <= 50""",
)
def gold_rank_by_date(spark, sf):
    df = trends.keyword_trends(t.curated(spark, sf), t.AS_OF, t.ALL_DAYS, rank_by_date=True)
    return df.select(
        "trend_date", "derived_genre", "platform_group", "network_type_norm", "isp_segment", "keyword_norm", "rank_today"
    )


@query(
    "top_keywords_by_genre",
    """SELECT keyword_norm, round(abandonment_rate, 6) AS abandonment_rate, rank_delta, search_count FROM gold WHERE derived_genre = 'THE_THAO'
       ORDER BY search_count DESC, keyword_norm, trend_date, platform_group, network_type_norm NULLS FIRST, isp_segment NULLS FIRST LIMIT 5""",
)
def top_keywords_by_genre(spark, sf):
    top = trends.top_keywords_by_genre(t.gold(spark, sf), "THE_THAO")
    return top.select("keyword_norm", "abandonment_rate", "rank_delta", "search_count")


_BOARD = "keyword_norm, network_type_norm, isp_segment, enter_count, rank_delta"
_ICON = "CASE WHEN rank_delta > 0 THEN '↑' WHEN rank_delta < 0 THEN '↓' ELSE '→' END AS trend_icon"


@query(
    "keyword_leaderboard",
    f"SELECT {_BOARD}, {_ICON} FROM gold WHERE derived_genre = 'NHAC' AND platform_group = 'SmartTV'",
)
def keyword_leaderboard(spark, sf):
    return trends.keyword_leaderboard(t.gold(spark, sf), "NHAC", "SmartTV").select(*_BOARD.split(", "), "trend_icon")


@query("trend_icon", f"SELECT {_BOARD}, {_ICON} FROM gold")
def trend_icon(spark, sf):
    return t.gold(spark, sf).select(*_BOARD.split(", "), trends.trend_icon(c("rank_delta")).alias("trend_icon"))


@query(
    "new_entrants",
    f"""SELECT CAST(trend_date AS VARCHAR) AS trend_date, keyword_norm, {o._SLOT}, rank_today
        FROM (SELECT *, rank() OVER (PARTITION BY {o._SLOT} ORDER BY enter_count DESC) AS rank_today FROM daily_stats WHERE trend_date >= '2024-01-16') d
        WHERE rank_today <= 50 AND NOT EXISTS (SELECT 1 FROM valid v WHERE v.dt BETWEEN '2024-01-08' AND '2024-01-14' AND length(v.keyword_norm) % 3 <> 0
          AND v.keyword_norm = d.keyword_norm AND v.derived_genre = d.derived_genre AND v.platform_group = d.platform_group)""",
)
def new_entrants(spark, sf):
    """Trends of the second half of the month; every third keyword length has no history before it."""
    known = (c("dt") > "2024-01-15") | (F.length("keyword_norm") % 3 != 0)
    gold = trends.keyword_trends(t.curated(spark, sf).where(known), date(2024, 1, 16), raw_events.DateWindow(start="2024-01-16"))
    return trends.new_entrants(gold).select("trend_date", "keyword_norm", "derived_genre", "platform_group", "rank_today")


@query(
    "curated_profile",
    """SELECT derived_genre, count(*) AS event_count, round(avg(CAST(is_search_abandoned AS INT)), 4) AS abandonment_rate,
         count(DISTINCT isp_segment) AS distinct_isps, count(DISTINCT user_id_hashed) AS unique_users
       FROM curated WHERE is_cross_partition_date = false GROUP BY 1""",
)
def curated_profile(spark, sf):
    return reports.curated_profile(t.curated(spark, sf))


@query(
    "gold_profile",
    f"""SELECT {o._SLOT}, count(*) AS keyword_slots, CAST(sum(search_count) AS BIGINT) AS total_searches,
          round(avg(abandonment_rate), 4) AS avg_abandonment_rate, count(CASE WHEN rank_delta > 0 THEN 1 END) AS rising_keywords
        FROM gold GROUP BY ALL ORDER BY total_searches DESC, {o._SLOT} LIMIT 20""",
)
def gold_profile(spark, sf):
    return reports.gold_profile(t.gold(spark, sf))


@query(
    "genre_distribution",
    "SELECT derived_genre, count(*) AS slots, CAST(sum(search_count) AS BIGINT) AS searches FROM gold GROUP BY 1",
)
def genre_distribution(spark, sf):
    return reports.genre_distribution(t.gold(spark, sf))


def _pivot_sql(row: str, value: str, cast: str) -> str:
    cells = ", ".join(f"{cast.format(f'{value} FILTER (WHERE platform_group = {o._q(p)})')} AS \"{p}\"" for p in PLATFORMS)
    return f"SELECT {row}, {cells} FROM gold GROUP BY 1"


@query("abandonment_heatmap", _pivot_sql("derived_genre", "avg(abandonment_rate)", "round({}, 6)"))
def abandonment_heatmap(spark, sf):
    return reports.abandonment_heatmap(t.gold(spark, sf))


@query("isp_platform_heatmap", _pivot_sql("isp_segment", "sum(unique_users)", "CAST({} AS BIGINT)"))
def isp_platform_heatmap(spark, sf):
    return reports.isp_platform_heatmap(t.gold(spark, sf))


@query(
    "classifier_coverage",
    """SELECT classified, unknown, round(100 * classified / CAST(classified + unknown AS DOUBLE), 6) AS classified_pct,
         round(100 * unknown / CAST(classified + unknown AS DOUBLE), 6) AS unknown_pct FROM (
         SELECT CAST(sum(search_count) FILTER (WHERE derived_genre <> 'UNKNOWN') AS BIGINT) AS classified,
                CAST(sum(search_count) FILTER (WHERE derived_genre = 'UNKNOWN') AS BIGINT) AS unknown FROM gold)""",
)
def classifier_coverage(spark, sf):
    return reports.classifier_coverage(t.gold(spark, sf))


# ---- baselines and anomalies ----------------------------------------------------------------------


@query("daily_enter_counts", "SELECT * FROM daily_counts")
def daily_enter_counts(spark, sf):
    return anomalies.daily_enter_counts(t.curated(spark, sf), t.AS_OF)


@query("baseline_stats", f"SELECT derived_genre, hour_of_day_vn, {_BASE}, genre_hour FROM baseline")
def baseline_stats(spark, sf):
    return t.baseline(spark, sf).drop("updated_at")


@query("format_4dp", "SELECT genre_hour, printf('%.4f', rolling_mean) AS mean_text, printf('%.4f', rolling_std) AS std_text FROM baseline")
def format_4dp(spark, sf):
    base = t.baseline(spark, sf)
    return base.select(
        "genre_hour", c("rolling_mean").cast("string").alias("mean_text"), c("rolling_std").cast("string").alias("std_text")
    )


@query("baseline_coverage", "SELECT count(*) AS slots, CAST(9 * 24 AS BIGINT) AS expected_slots FROM baseline")
def baseline_coverage(spark, sf):
    return reports.baseline_coverage(t.baseline(spark, sf))


@query("anomaly_buckets", "SELECT derived_genre, hour_of_day_vn, count(*) AS observed_count FROM curated WHERE session_action = 'enter' GROUP BY ALL")
def anomaly_buckets(spark, sf):
    return anomalies.enter_buckets(t.curated(spark, sf))


@query("anomaly_score", "SELECT dt, derived_genre, hour_of_day_vn, round(z_score, 6) AS z_score, is_anomaly, anomaly_type FROM scored")
def anomaly_score(spark, sf):
    return _scored(spark, sf).select("dt", "derived_genre", "hour_of_day_vn", "z_score", "is_anomaly", "anomaly_type")


@query(
    "anomaly_score_metrics",
    """SELECT 'AnomalyScore' AS metric_name, derived_genre AS genre, CAST(hour_of_day_vn AS VARCHAR) AS hour,
         round(abs(z_score), 6) AS value, 'None' AS unit FROM scored""",
)
def anomaly_score_metrics(spark, sf):
    points = anomalies.score_metrics(_scored(spark, sf))
    return points.select(
        "metric_name", c("dimensions.Genre").alias("genre"), c("dimensions.Hour").alias("hour"), "value", "unit"
    )


@query(
    "injected_spike",
    """SELECT dt, derived_genre, hour_of_day_vn, observed_count, round(z, 6) AS z_score FROM (
         SELECT i.*, (observed_count - coalesce(rolling_mean, 0)) / greatest(coalesce(rolling_std, 0), 1.0) AS z FROM (
           SELECT dt, derived_genre, hour_of_day_vn, CASE WHEN derived_genre = 'THE_THAO' AND hour_of_day_vn = 20 THEN 10 ELSE 1 END * observed_count AS observed_count
           FROM day_buckets) i LEFT JOIN (SELECT derived_genre, hour_of_day_vn, rolling_mean, rolling_std FROM baseline) USING (derived_genre, hour_of_day_vn))
       WHERE z > 3""",
)
def injected_spike(spark, sf):
    scored = anomalies.score(replay.inject_anomaly(t.curated(spark, sf)), t.baseline(spark, sf), by=["dt"])
    return scored.where(c("anomaly_type") == "SPIKE").select(
        "dt", "derived_genre", "hour_of_day_vn", "observed_count", "z_score"
    )


@query(
    "throughput_metrics",
    """SELECT CASE session_action WHEN 'enter' THEN 'SearchEnterEventsPerMinute' ELSE 'SearchQuitEventsPerMinute' END AS metric_name,
         derived_genre AS genre, platform_group, CAST(count(*) AS DOUBLE) AS value, 'Count' AS unit
       FROM curated WHERE session_action IN ('enter', 'quit') GROUP BY ALL""",
)
def throughput_metrics(spark, sf):
    points = anomalies.throughput_metrics(t.curated(spark, sf))
    return points.select(
        "metric_name", c("dimensions.Genre").alias("genre"), c("dimensions.PlatformGroup").alias("platform_group"), "value", "unit"
    )


@query("anomaly_breakdown", "SELECT anomaly_type, count(*) AS anomalies FROM anomalies GROUP BY 1")
def anomaly_breakdown(spark, sf):
    return anomalies.anomaly_breakdown(_anomalies(spark, sf))


@query(
    "anomaly_timeline",
    """SELECT anomaly_id, derived_genre, hour_of_day_vn, round(z_score, 6) AS z_score, anomaly_type, observed_count, score_ts,
         CAST(3 AS DOUBLE) AS upper_line, CAST(-3 AS DOUBLE) AS lower_line FROM anomalies""",
)
def anomaly_timeline(spark, sf):
    return anomalies.anomaly_timeline(_anomalies(spark, sf))


@query(
    "alert_events",
    """SELECT anomaly_id, 'SearchAnomalyDetected' AS detail_type, derived_genre, hour_of_day_vn, observed_count,
         round(z_score, 6) AS z_score, anomaly_type FROM anomalies""",
)
def alert_events(spark, sf):
    alerts = anomalies.alert_events(_anomalies(spark, sf))
    detail = F.from_json(
        "detail", "derived_genre string, hour_of_day_vn bigint, observed_count bigint, z_score double, anomaly_type string"
    )
    return alerts.select("anomaly_id", "detail_type", detail.alias("d")).select("anomaly_id", "detail_type", "d.*")


# ---- streaming ------------------------------------------------------------------------------------


def _follow(spark, written: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """Stream of a written table's files."""
    folder = written.inputFiles()[0].rsplit("/", 1)[0]
    return jobs.follow(spark, folder, written.schema, files_per_batch)


@query(
    "stream_raw_sink",
    f"""SELECT {_RAW_COLUMNS}, nullif(left(datetime, 10), '') AS dt, nullif(substr(datetime, 12, 2), '') AS hour, 'ALL' AS derived_genre, 'ALL' AS platform_group, false AS dead
        FROM search_log WHERE CAST(eventid AS BIGINT) % 17 <> 0
        UNION ALL SELECT {', '.join(['NULL'] * 13)}, true FROM search_log WHERE CAST(eventid AS BIGINT) % 17 = 0""",
)
def stream_raw_sink(spark, sf):
    """Partitioned by all four keys, of which genre and platform are of one kind here; damaged records end as dead letters."""
    folder, out = staging_path(spark, "encoded"), staging_path(spark, "raw-sink")
    extras = {"derived_genre": F.lit("ALL"), "platform_group": F.lit("ALL")}
    _encoded(spark, sf, extras).write.parquet(folder)
    stream = spark.readStream.schema("data string").parquet(folder)
    jobs.run_to_end(jobs.start_raw_sink(stream, out, available_now=True))
    good = spark.read.schema(jobs.SINK_SCHEMA).parquet(f"{out}/data")
    dead = spark.read.schema("data string").parquet(f"{out}/dead")
    keys = [F.nullif(k, F.lit(_HIVE_NULL)).alias(k) for k in ("dt", "hour", "derived_genre", "platform_group")]
    return good.select(*_RAW_COLUMNS.split(", "), *keys, F.lit(False).alias("dead")).unionByName(
        dead.select(F.lit(True).alias("dead")), allowMissingColumns=True
    )


@query(
    "stream_enrich",
    f"""SELECT s.eventid, {_padded.replace('datetime', 's.datetime')} AS datetime_clean, nullif({o._strip('lower(s.keyword)')}, '') AS keyword_norm,
          coalesce(l.derived_genre, 'UNKNOWN') AS derived_genre, {o._platform('s.platform')} AS platform_group
        FROM search_log s LEFT JOIN (SELECT DISTINCT keyword_norm, derived_genre FROM labels) l ON l.keyword_norm = lower(trim(s.keyword))""",
)
def stream_enrich(spark, sf):
    out = staging_path(spark, "enriched")
    stream = _follow(spark, t.search_log(spark, sf))
    jobs.run_to_end(jobs.start_enrich(stream, t.lut(spark, sf), out, available_now=True))
    rows = spark.read.schema(jobs.ENRICHED_SCHEMA).parquet(out)
    return rows.select(
        "eventid", F.rpad("datetime_clean", 23, "0").alias("datetime_clean"), "keyword_norm", "derived_genre", "platform_group"
    )


_Z = "round((observed_count - coalesce(rolling_mean, 0)) / greatest(coalesce(rolling_std, 0), 1.0), 6)"
_SLOTS = "LEFT JOIN (SELECT derived_genre, hour_of_day_vn, rolling_mean, rolling_std FROM baseline) USING (derived_genre, hour_of_day_vn)"


_ARRIVING = ["event_id", "event_ts", "session_action", "derived_genre", "hour_of_day_vn", "platform_group"]


def _arrive(spark, df: DataFrame, groups: list, *starts) -> None:
    """Let the rows of each condition arrive one after the other, and run the streams to their end each time.

    Each arrival is a micro-batch of all its files, as many as were written. It holds the columns that the streams read and the conditions ask for.
    """
    folder, df = staging_path(spark, "arrivals"), df.select(*_ARRIVING)
    for condition in groups:
        df.where(condition).write.mode("append").parquet(folder)
        for start in starts:
            jobs.run_to_end(start(jobs.follow(spark, folder, df.schema)))


@query(
    "stream_anomaly",
    """SELECT 'scored' AS kind, window_start, derived_genre, hour_of_day_vn, observed_count, z AS z_score FROM closed
        UNION ALL SELECT 'anomaly', NULL, derived_genre, hour_of_day_vn, observed_count, round(z, 4) FROM closed WHERE abs(z) > 3
        UNION ALL SELECT 'alert', NULL, derived_genre, hour_of_day_vn, observed_count, round(z, 4) FROM closed WHERE abs(z) > 3
        UNION ALL SELECT 'metric', NULL, derived_genre, hour_of_day_vn, NULL, abs(z) FROM closed""",
)
def stream_anomaly(spark, sf):
    """Hours are scored once they are over; rows of the third day that come after all others are too late and left out."""
    base_root, out = staging_path(spark, "baseline"), staging_path(spark, "window-anomalies")
    sinks.write_baseline(t.baseline(spark, sf), base_root)
    entered = t.curated(spark, sf).where("session_action = 'enter' AND year(event_ts) = 2024")
    late = (F.dayofmonth("event_ts") == 3) & (F.col("event_id").cast("bigint") % 10 == 0)
    days = F.dayofmonth("event_ts")
    groups = [~late & days.between(a, b) for a, b in ((1, 10), (11, 20), (21, 31))] + [late]
    _arrive(spark, entered, groups, lambda stream: jobs.start_anomaly(stream, base_root, out, scope="window", available_now=True))
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    detail = F.from_json("detail", "derived_genre string, hour_of_day_vn bigint, observed_count bigint, z_score double")
    dims = [c("dimensions")["Genre"].alias("derived_genre"), c("dimensions")["Hour"].cast("bigint").alias("hour_of_day_vn")]
    columns = ["window_start", "derived_genre", "hour_of_day_vn", "observed_count", "z_score"]
    parts = [
        read("scored").select(F.lit("scored").alias("kind"), *columns),
        read("anomalies").select(F.lit("anomaly").alias("kind"), *columns[1:]),
        read("alerts").select(F.lit("alert").alias("kind"), detail.alias("d")).select("kind", "d.*"),
        read("metrics").select(F.lit("metric").alias("kind"), *dims, c("value").alias("z_score")),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("z_score", c("z_score").cast("double")) for p in parts])


@query(
    "stream_silence",
    f"""SELECT window_start, derived_genre, hour_of_day_vn, observed_count, z AS z_score, z < -3 AS dropped FROM (
          SELECT window_start, derived_genre, hour_of_day_vn, observed_count, z FROM closed
          UNION ALL SELECT window_start, derived_genre, hour_of_day_vn, 0, round((0 - coalesce(rolling_mean, 0)) / greatest(coalesce(rolling_std, 0), 1.0), 6)
          FROM (SELECT unnest(range((SELECT min(window_start) FROM closed), (SELECT max(window_start) FROM closed) + 1, 3600000)) AS window_start) h
          JOIN baseline b ON b.hour_of_day_vn = (window_start // 3600000 + 7) % 24
          ANTI JOIN closed USING (window_start, derived_genre, hour_of_day_vn))""",
)
def stream_silence(spark, sf):
    """Every slot of the baseline in every closed hour, those without an event as well."""
    base_root, out = staging_path(spark, "baseline"), staging_path(spark, "silence")
    sinks.write_baseline(t.baseline(spark, sf), base_root)
    entered = t.curated(spark, sf).where("session_action = 'enter' AND year(event_ts) = 2024")
    late = (F.dayofmonth("event_ts") == 3) & (F.col("event_id").cast("bigint") % 10 == 0)
    days = F.dayofmonth("event_ts")
    groups = [~late & days.between(a, b) for a, b in ((1, 10), (11, 20), (21, 31))] + [late]
    _arrive(spark, entered, groups, lambda stream: jobs.start_anomaly(stream, base_root, out, scope="window", silence=True, available_now=True))
    scored = spark.read.parquet(f"{out}/scored")
    dropped = F.coalesce(c("anomaly_type") == "DROP", F.lit(False))
    return scored.select("window_start", "derived_genre", "hour_of_day_vn", "observed_count", "z_score", dropped.alias("dropped"))


@query(
    "stream_anomaly_batch",
    f"""SELECT derived_genre, hour_of_day_vn, observed_count, {_Z} AS z_score FROM (
          SELECT CAST(event_id AS BIGINT) % 3 AS part, derived_genre, hour_of_day_vn, count(*) AS observed_count FROM curated
          WHERE session_action = 'enter' GROUP BY ALL) {_SLOTS}""",
)
def stream_anomaly_batch(spark, sf):
    """The counts within each micro-batch, scored."""
    base_root, out = staging_path(spark, "baseline"), staging_path(spark, "batch-anomalies")
    sinks.write_baseline(t.baseline(spark, sf), base_root)
    part = F.col("event_id").cast("bigint") % 3
    groups = [part == i for i in range(3)]
    _arrive(spark, t.curated(spark, sf), groups, lambda stream: jobs.start_anomaly(stream, base_root, out, scope="batch", available_now=True))
    return spark.read.schema(jobs.SCORED_SCHEMA).parquet(f"{out}/scored").select("derived_genre", "hour_of_day_vn", "observed_count", "z_score")


_BAD = 5003
_SENT = 150_000


@query(
    "stream_bisect",
    f"""SELECT CAST(eventid AS BIGINT) AS event, CAST(length(keyword) AS BIGINT) AS letters, false AS dead, NULL AS tries FROM search_log WHERE CAST(eventid AS BIGINT) % {_BAD} <> 7
        UNION ALL SELECT CAST(eventid AS BIGINT), NULL, true, 3 FROM search_log WHERE CAST(eventid AS BIGINT) % {_BAD} = 7""",
)
def stream_bisect(spark, sf):
    """A few records make the decoding of their whole micro-batch fail; all others are published.

    One record in ``_BAD`` is bad, so micro-batches take two files of at most ``_SENT`` records, far fewer than the 100 bad ones that stop a stream.
    """
    out, event = staging_path(spark, "decoded"), F.col("eventid").cast("bigint")
    sent = t.search_log(spark, sf).select("eventid", F.when(event % _BAD == 7, F.concat(F.lit("no number "), "eventid")).otherwise(F.col("eventid")).alias("code"), "keyword")
    sent.write.option("maxRecordsPerFile", _SENT).parquet(folder := staging_path(spark, "sent"))

    # Made once: decoding is set up anew for every attempt, and building expressions took longer than running them.
    number = F.try_to_number("code", F.lit("999999999999999"))
    number = F.when(number.isNull(), F.raise_error(F.concat(F.lit("bad code: "), "code"))).otherwise(number)
    decoded = [number.cast("bigint").alias("event"), F.length("keyword").cast("bigint").alias("letters")]

    def decode(rows: DataFrame) -> DataFrame:
        return rows.select(*decoded)

    jobs.run_to_end(jobs.start_decode(jobs.follow(spark, folder, sent.schema, files_per_batch=2), decode, out, available_now=True))
    good = spark.read.schema("event bigint, letters bigint").parquet(f"{out}/data").select("event", "letters").withColumns({"dead": F.lit(False), "tries": F.lit(None).cast("bigint")})
    dead = spark.read.schema("eventid string, tries int").parquet(f"{out}/dead")
    return good.unionByName(dead.select(c("eventid").cast("bigint").alias("event"), F.lit(None).cast("bigint").alias("letters"), F.lit(True).alias("dead"), c("tries").cast("bigint").alias("tries")))


@query(
    "anomaly_expiry",
    "SELECT dt AS score_day, derived_genre, hour_of_day_vn, observed_count FROM scored WHERE is_anomaly AND dt BETWEEN '2024-01-20' AND '2024-01-31'",
)
def anomaly_expiry(spark, sf):
    """Anomalies scored at the end of their days and appended day after day; what is older than 30 days goes."""
    path, day = staging_path(spark, "anomalies"), F.try_to_timestamp(F.concat("dt", F.lit(" 23:59:59")))
    rows = stage(anomalies.anomaly_rows(_scored(spark, sf), F.coalesce("dt", F.lit("none")), day), "scored-days")
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-10", "2024-01-22"), ("2024-01-20", "2024-02-01")):
        sinks.append_anomalies(rows.where(c("score_ts").between(low, high)), path)
    sinks.expire_anomalies(spark, path, datetime(2024, 2, 19, 12))
    kept = sinks.read_anomalies(spark, path, rows.schema)
    return kept.select(F.left("score_ts", F.lit(10)).alias("score_day"), "derived_genre", "hour_of_day_vn", "observed_count")


@query(
    "stream_throughput",
    """SELECT CAST(epoch_ms(date_trunc('minute', event_ts)) AS BIGINT) AS window_start, derived_genre, platform_group,
         count(*) FILTER (WHERE session_action = 'enter') AS enter_events, count(*) FILTER (WHERE session_action = 'quit') AS quit_events
       FROM curated WHERE session_action IN ('enter', 'quit') GROUP BY ALL""",
)
def stream_throughput(spark, sf):
    out = staging_path(spark, "throughput")
    stream = _follow(spark, t.curated(spark, sf))
    jobs.run_to_end(jobs.start_throughput(stream, out, watermark="60 days", available_now=True))
    return jobs.latest_throughput(spark, out)


@query(
    "stream_closed_minutes",
    """SELECT CAST(epoch_ms(date_trunc('minute', event_ts)) AS BIGINT) AS window_start, derived_genre, platform_group,
         count(*) FILTER (WHERE session_action = 'enter') AS enter_events, count(*) FILTER (WHERE session_action = 'quit') AS quit_events
       FROM curated WHERE session_action IN ('enter', 'quit') AND year(event_ts) = 2024 GROUP BY ALL""",
)
def stream_closed_minutes(spark, sf):
    """The month in three arrivals: most minutes are read as closed, the last ones as far as they are known."""
    out, day = staging_path(spark, "minutes"), F.dayofmonth("event_ts")
    rows = t.curated(spark, sf).where("year(event_ts) = 2024")
    groups = [day.between(a, b) for a, b in ((1, 10), (11, 20), (21, 31))]
    _arrive(spark, rows, groups, *(lambda stream, start=start: start(stream, out, available_now=True) for start in (jobs.start_throughput, jobs.start_closed_minutes)))
    return jobs.latest_throughput(spark, out)


# ---- alarms, governance, data quality -------------------------------------------------------------


def _alarm_sql(rule: alarms.AlarmRule) -> str:
    p = rule.period_seconds
    start = f"CAST(floor(epoch(ts) / {p}) AS BIGINT) * {p}"

    def stat(metric: str) -> str:
        return f"{rule.stat}(value) FILTER (WHERE metric_name = '{metric}')"

    value = stat(rule.metric)
    if rule.ratio_to:
        value = f"{value} / greatest({value}, {stat(rule.ratio_to)})"
    return f"""SELECT '{rule.name}' AS alarm, s.period_start, round(v.value, 6) AS value,
        coalesce(v.value {rule.comparison} {rule.threshold}, {str(rule.missing_breaches).lower()}) AS breaching
      FROM (SELECT unnest(range({1704067200 // p * p}, {1709121600 // p * p + 1}, {p})) AS period_start) s
      LEFT JOIN (SELECT {start} AS period_start, {value} AS value FROM metrics GROUP BY 1) v USING (period_start)"""


_TIMELINE = " UNION ALL ".join(_alarm_sql(r) for r in alarms.DEFAULT_RULES)


@query("alarm_timeline", _TIMELINE)
def alarm_timeline(spark, sf):
    return alarms.alarm_timeline(t.metrics(spark, sf), datetime(2024, 1, 1), datetime(2024, 2, 28, 12))


def _trailing_sql(rule: alarms.AlarmRule, moments: str) -> str:
    """The rule at each of the moments, by a range join with the points of the period that ends there."""

    def stat(metric: str) -> str:
        return f"{rule.stat}(value) FILTER (WHERE metric_name = '{metric}')"

    value = stat(rule.metric)
    if rule.ratio_to:
        value = f"{value} / greatest({value}, {stat(rule.ratio_to)})"
    return f"""SELECT '{rule.name}' AS alarm, moment, {rule.period_seconds} AS period, value, coalesce(value {rule.comparison} {rule.threshold}, {str(rule.missing_breaches).lower()}) AS breaching
      FROM (SELECT m.moment, {value} AS value FROM ({moments}) m LEFT JOIN metrics p
            ON epoch(p.ts) > m.moment - {rule.period_seconds} AND epoch(p.ts) <= m.moment GROUP BY m.moment)"""


def _all_trailing(moments: str) -> str:
    return " UNION ALL ".join(_trailing_sql(r, moments) for r in alarms.DEFAULT_RULES)


@query(
    "alarm_eval",
    f"""SELECT alarm, period_start, value, breaching FROM (WITH states AS ({_all_trailing("SELECT 1709121600 AS moment")})
        SELECT alarm, moment - period AS period_start, coalesce(round(value, 6), -1) AS value, breaching FROM states
        UNION ALL SELECT 'health', max(moment - period), NULL, bool_or(breaching) FROM states)""",
)
def alarm_eval(spark, sf):
    states = alarms.evaluate_alarms(t.metrics(spark, sf), datetime(2024, 2, 28, 12))
    shown = F.when(c("alarm") != alarms.COMPOSITE, F.coalesce("value", F.lit(-1.0)))
    return states.withColumn("value", shown)


@query(
    "alarm_episodes",
    f"""SELECT * FROM (WITH single AS ({_all_trailing("SELECT unnest(range(1706745600, 1706918401, 300)) AS moment")}),
          states AS (SELECT alarm, moment, breaching FROM single UNION ALL SELECT 'health', moment, bool_or(breaching) FROM single GROUP BY moment),
          marked AS (SELECT *, breaching IS DISTINCT FROM lag(breaching) OVER w AND lag(moment) OVER w IS NOT NULL AS changed FROM states WINDOW w AS (PARTITION BY alarm ORDER BY moment)),
          islands AS (SELECT *, sum(changed::INT) OVER (PARTITION BY alarm ORDER BY moment) AS island FROM marked),
          found AS (SELECT alarm, any_value(breaching) AS breaching, min(moment) AS since, count(*) AS moments FROM islands GROUP BY alarm, island)
        SELECT alarm, if(breaching, 'ALARM', 'OK') AS state, since * 1000 AS since, lead(since) OVER (PARTITION BY alarm ORDER BY since) * 1000 AS until, moments FROM found)""",
)
def alarm_episodes(spark, sf):
    """Two days judged every five minutes, each alarm by itself and all together."""
    states = alarms.alarm_states(t.metrics(spark, sf), datetime(2024, 2, 1), datetime(2024, 2, 3), every_seconds=300)
    return alarms.alarm_episodes(alarms.with_composite(states))


@query("role_view", "SELECT " + ", ".join(
    {"abandonment_rate": "round(abandonment_rate, 6) AS abandonment_rate", "trend_date": "CAST(trend_date AS VARCHAR) AS trend_date"}.get(x, x)
    for x in governance.MARKETING_COLUMNS) + " FROM gold")
def role_view(spark, sf):
    return governance.role_view(t.gold(spark, sf), "gold", "marketing")


_PHONE = governance.PII_PATTERNS["vn_phone"]
_PII = [
    ("documents", ("text", "lang", "source")), ("conversations", ("role", "text")),
    ("search_log", ("eventid", "datetime", "user_id", "keyword", "category", "proxy_isp", "platform", "networktype", "action", "userplansmap", "dt", "hour")),
]


def _pii_sql(table: str, col: str) -> str:
    found = f"regexp_extract_all({f'array_to_string({col}, chr(10))' if col == 'userplansmap' else col}, '{_PHONE}')"
    return f"""SELECT '{table}' AS table_name, 'vn_phone' AS pattern, '{col}' AS "column", count(*) AS rows_scanned,
        count(*) FILTER (WHERE len({found}) > 0) AS rows_hit, CAST(coalesce(sum(len({found})), 0) AS BIGINT) AS matches,
        min(list_min({found})) AS sample FROM {table}"""


@query("pii_scan", " UNION ALL ".join(_pii_sql(table, col) for table, cols in _PII for col in cols))
def pii_scan(spark, sf):
    frames = {table: t.search_log(spark, sf) if table == "search_log" else t.source(spark, sf, table) for table, _ in _PII}
    return reduce(DataFrame.unionByName, [governance.pii_scan(df).withColumn("table_name", F.lit(table)) for table, df in frames.items()])


@query(
    "dq_profile",
    """SELECT count(*) AS total_rows, count(*) FILTER (WHERE datetime IS NULL) AS missing,
         count(*) FILTER (WHERE regexp_matches(datetime, '[٠-٩]')) AS arabic_digits,
         count(*) FILTER (WHERE regexp_matches(datetime, '[۰-۹]')) AS extended_arabic_digits,
         count(*) FILTER (WHERE starts_with(datetime, '2565')) AS buddhist_year,
         count(*) FILTER (WHERE year(event_ts) < 2015) AS corrupt_year,
         count(*) FILTER (WHERE datetime IS NOT NULL AND event_ts IS NULL) AS unparseable,
         count(*) FILTER (WHERE year(event_ts) >= 2015 AND year(event_ts) <> try_cast(left(dt, 4) AS INT)) AS cross_partition
       FROM parsed""",
)
def dq_profile(spark, sf):
    return governance.dq_profile(t.search_log(spark, sf))


# ---- evaluation and lookup curation ---------------------------------------------------------------


@query("eval_keywords", "SELECT * FROM eval_keywords")
def eval_keywords(spark, sf):
    return t.eval_keywords(spark, sf)


@query("eval_compare", "SELECT * FROM compared")
def eval_compare(spark, sf):
    return t.compared(spark, sf)


@query(
    "confusion_matrix",
    f"""SELECT a.g AS rules_genre, b.g AS oracle_genre, count(keyword_norm) AS keywords, CAST(coalesce(sum(search_count), 0) AS BIGINT) AS volume
        FROM {o._DOMAIN} a(g), {o._DOMAIN} b(g) LEFT JOIN compared ON rules_genre = a.g AND oracle_genre = b.g GROUP BY ALL""".replace(
        f"FROM {o._DOMAIN} a(g), {o._DOMAIN} b(g) LEFT JOIN", f"FROM {o._DOMAIN} a(g) CROSS JOIN {o._DOMAIN} b(g) LEFT JOIN"
    ),
)
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(t.compared(spark, sf))


_VOLUMES = ", ".join(f"CAST({k}_volume AS BIGINT) AS {k}_volume" for k in ("tp", "fp", "fn"))
_RATIOS = ", ".join(
    f"round(CAST({k}{s} AS DOUBLE), 6) AS {k}{s}" for s in ("", "_volume") for k in ("precision", "recall", "f1")
)


@query("genre_prf", f"SELECT genre, tp, fp, fn, {_VOLUMES}, CAST(support AS BIGINT) AS support, {_RATIOS} FROM prf")
def genre_prf(spark, sf):
    return evaluation.genre_prf(t.compared(spark, sf))


@query(
    "macro_scores",
    """SELECT round(avg(f1), 6) AS macro_f1, round(avg(f1_volume), 6) AS macro_f1_volume,
         round(avg(precision_volume), 6) AS macro_precision_volume FROM prf""",
)
def macro_scores(spark, sf):
    return evaluation.macro_scores(evaluation.genre_prf(t.compared(spark, sf)))


@query(
    "eval_accuracy",
    """SELECT count(*) AS keywords, CAST(sum(search_count) AS BIGINT) AS volume, count(*) FILTER (WHERE agree) AS agree_keywords,
         CAST(coalesce(sum(search_count) FILTER (WHERE agree), 0) AS BIGINT) AS agree_volume,
         round(count(*) FILTER (WHERE agree) / CAST(count(*) AS DOUBLE), 6) AS count_accuracy,
         round(coalesce(sum(search_count) FILTER (WHERE agree), 0) / CAST(sum(search_count) AS DOUBLE), 6) AS volume_accuracy FROM compared""",
)
def eval_accuracy(spark, sf):
    return evaluation.eval_accuracy(t.compared(spark, sf))


_WRONG = """(SELECT *, row_number() OVER (ORDER BY search_count DESC, keyword_norm) AS rn FROM compared WHERE NOT agree)"""


@query(
    "top_misclassified",
    f"""SELECT keyword_norm, rules_genre, oracle_genre, CAST(1 AS BIGINT) AS keywords, search_count FROM {_WRONG} WHERE rn <= 5
        UNION ALL SELECT NULL, NULL, NULL, count(*), CAST(coalesce(sum(search_count), 0) AS BIGINT) FROM {_WRONG} WHERE rn > 5""",
)
def top_misclassified(spark, sf):
    return evaluation.top_misclassified(t.compared(spark, sf), n=5)


def _cases(spark, sf) -> DataFrame:
    return evaluation.build_test_cases(t.compared(spark, sf), t.adjudicated(spark, sf))


@query("build_test_cases", "SELECT * FROM cases")
def build_test_cases(spark, sf):
    return _cases(spark, sf)


@query(
    "test_set_summary",
    "SELECT expected_genre, confidence, count(*) AS keywords, CAST(sum(search_count) AS BIGINT) AS volume FROM cases GROUP BY ALL",
)
def test_set_summary(spark, sf):
    return evaluation.test_set_summary(_cases(spark, sf))


_STRONG = o._regex_genre("keyword", genres.STRONG_GENRES)
_CONFLICTS = f"(SELECT keyword, genre AS lut_genre, {_STRONG} AS regex_genre FROM lut_ext WHERE {_STRONG} <> genre)"


@query("lookup_conflicts", f"SELECT * FROM {_CONFLICTS}")
def lookup_conflicts(spark, sf):
    return curation.lookup_conflicts(t.lut_ext(spark, sf))


@query("conflict_breakdown", f"SELECT lut_genre, regex_genre, count(*) AS entries FROM {_CONFLICTS} GROUP BY ALL")
def conflict_breakdown(spark, sf):
    return curation.conflict_breakdown(curation.lookup_conflicts(t.lut_ext(spark, sf)))


@query("fix_conflicts", f"SELECT keyword, coalesce({_STRONG}, genre) AS genre FROM lut_ext")
def fix_conflicts(spark, sf):
    return curation.fix_conflicts(t.lut_ext(spark, sf)).select("keyword", "genre")


def _plan(spark, sf) -> DataFrame:
    return curation.plan_lookup_fixes(
        t.compared(spark, sf), t.lut(spark, sf), t.lut_ext(spark, sf),
        lut_min_volume=200, ext_min_volume=50, promote_min_volume=100,
    )


@query("plan_lookup_fixes", "SELECT * FROM fix_plan")
def plan_lookup_fixes(spark, sf):
    return _plan(spark, sf)


_DIRECT = f"(VALUES {o._values(curation.DIRECT_FIXES.items())})"


@query(
    "apply_lookup_fixes",
    f"""SELECT keyword, coalesce(f.new_genre, d.genre, e.genre) AS genre, coalesce(f.new_genre, d.genre, e.genre) IS DISTINCT FROM e.genre AS changed
        FROM (SELECT keyword, genre FROM lut_ext) e FULL JOIN {_DIRECT} d(keyword, genre) USING (keyword)
          FULL JOIN (SELECT keyword, new_genre FROM fix_plan WHERE target = 'lut_ext') f USING (keyword)""",
)
def apply_lookup_fixes(spark, sf):
    direct = spark.createDataFrame(list(curation.DIRECT_FIXES.items()), "keyword string, genre string")
    return curation.apply_lookup_fixes(t.lut_ext(spark, sf), _plan(spark, sf).where("target = 'lut_ext'"), direct)


@query(
    "fix_summary",
    "SELECT target, old_genre, new_genre, count(*) AS entries FROM fix_plan WHERE old_genre <> new_genre GROUP BY ALL",
)
def fix_summary(spark, sf):
    return curation.fix_summary(_plan(spark, sf))
