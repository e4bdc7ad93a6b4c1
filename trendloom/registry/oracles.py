"""DuckDB SQL twins of the registered queries.

Each query names the common tables it needs; these become CTEs in front of its text.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from trendloom.fixtures import sql
from trendloom.functions.genres import GENRE_ORDER, STRONG_GENRES, genre_alternation
from trendloom.functions.text import GENRE_ALIASES
from trendloom.operators.curation import DIRECT_FIXES, LABELLER_MISTAKES
from trendloom.schemas import GENRES, PLATFORMS
from trendloom.sources.lookups import SEED_LOOKUP


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else _q(x) for x in r) + ")" for r in rows)


def _fill(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^\\s+', ''), '\\s+$', '')"


DATE = "^(\\d{4}-\\d{2}-\\d{2})\\s+(\\d{1,2}):(\\d{2}):(\\d{2})(?:\\.(\\d+))?"


def _clean(c: str) -> str:
    s = f"translate({_strip(c)}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')"
    s = f"(CASE WHEN starts_with({s}, '2565') THEN '2022' || substr({s}, 5) ELSE {s} END)"

    def g(i: int) -> str:
        return f"regexp_extract({s}, '{DATE}', {i})"

    frac = f"(CASE WHEN {g(5)} = '' THEN '000' ELSE left({g(5)}, 3) END)"
    return (
        f"(CASE WHEN regexp_matches({s}, '{DATE}') THEN {g(1)} || ' ' || lpad({g(2)}, 2, '0') || ':' || {g(3)} "
        f"|| ':' || {g(4)} || '.' || {frac} END)"
    )


def _platform(c: str) -> str:
    p = _strip(f"lower({c})")
    return (
        f"(CASE WHEN starts_with({p}, 'fplay-ottbox') OR {p} IN ('androidtvboxhis22', 'fplay-gr-android-box') THEN 'OTTBox' "
        f"WHEN contains({p}, 'smarttv') OR contains({p}, 'smart-tv') THEN 'SmartTV' "
        f"WHEN {p} IN ('android', 'vsmart') THEN 'Android' WHEN {p} = 'ios' THEN 'iOS' "
        f"WHEN contains({p}, 'web') THEN 'Web' ELSE 'Other' END)"
    )


def _network(c: str) -> str:
    n = _strip(f"upper({c})")
    return (
        f"(CASE WHEN {n} IN ('WIFI', 'WLAN') THEN 'WiFi' WHEN {n} IN ('WWAN', '3G', '4G', 'LTE', '5G') THEN 'Mobile' "
        f"WHEN {n} = 'ETHERNET' THEN 'Ethernet' WHEN {n} IN ('CAB', 'CABLE') THEN 'Cable' ELSE 'Unknown' END)"
    )


def _premium(c: str) -> str:
    return (
        f"coalesce(len(list_filter({c}, lambda e: trim(split_part(e, ':', 1)) IN "
        "('VIP', 'HBO GO+', 'K+', 'MAX', 'MAX XMAS'))) > 0, false)"
    )


def _preprocess(c: str) -> str:
    s = f"trim(regexp_replace(regexp_replace({c}, '[ ​　]+', ' ', 'g'), '\\s+', ' ', 'g'))"
    s = f"regexp_replace({s}, '^\\s*\\[[^\\]]{{1,30}}\\]\\s*', '')"
    s = f"regexp_replace({s}, '\\s*\\([^)]{{1,30}}\\)', '', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+(?:tap|ep|episode|phan|part)\\s*\\d+\\s*$', '', 'i'))"
    chars = f"string_split({s}, '')"
    keep = f"list_filter({chars}, lambda ch, i: i < 3 OR NOT (ch = {chars}[i - 1] AND ch = {chars}[i - 2]))"
    return f"trim(array_to_string({keep}, ''))"


def _regex_genre(c: str, genres=GENRE_ORDER) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({c}, {_q('(?i)' + genre_alternation(g))}) THEN '{g}'" for g in GENRE_ORDER if g in genres
    )
    return f"(CASE {whens} END)"


def _normalize(c: str) -> str:
    u = _strip(f"upper({c})")
    whens = " ".join(f"WHEN '{a}' THEN '{g}'" for a, g in GENRE_ALIASES.items())
    alias = f"(CASE {u} {whens} ELSE {u} END)"
    return f"(CASE WHEN {alias} IN ({', '.join(map(_q, GENRES))}) THEN {alias} ELSE 'UNKNOWN' END)"


def _tokens(c: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({c}, '\\s+'), lambda t: t <> ''))"


_LUT = json.loads(Path(SEED_LOOKUP).read_text(encoding="utf-8"))
_DOMAIN = "(VALUES " + _values((g,) for g in GENRES) + ")"
_SLOT = "derived_genre, platform_group"


def _indel_columns(x: str, y: str) -> str:
    """Longest common subsequence by one row of the classic table per letter of y."""
    n = f"length({x})"
    cell = (
        f"CASE WHEN substr({x}, i, 1) = ch THEN (CASE WHEN i = 1 THEN 0 ELSE acc[i - 1] END) + 1 ELSE acc[i] END"
    )
    row = (
        f"list_transform(range(1, {n} + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: {cell})))"
    )
    return row


# Common tables, in an order in which each only needs earlier ones.
TABLES: dict[str, str] = {
    "search_log": _fill(sql.SEARCH_LOG),
    "titles": _fill(sql.TITLES),
    "lut": f"SELECT * FROM (VALUES {_values((k, g, i) for i, (k, g) in enumerate(_LUT.items()))}) v(keyword, genre, ordinal)",
    "lut_ext": _fill(sql.LUT_EXT),
    "sentences": "SELECT unnest(string_split(text, '.')) AS sentence FROM conversations",
    "keyword_pool": _fill(sql.KEYWORD_POOL),
    "parsed": f"SELECT *, try_cast({_clean('datetime')} AS TIMESTAMP) AS event_ts FROM search_log",
    "repaired": "SELECT * FROM parsed WHERE year(event_ts) >= 2015",
    "forms": (
        f"SELECT keyword_norm, {_preprocess('keyword_norm')} AS kw FROM "
        "(SELECT DISTINCT lower(trim(keyword)) AS keyword_norm FROM repaired WHERE keyword IS NOT NULL)"
    ),
    "subset_hits": (
        f"SELECT kw, arg_min(genre, ordinal) AS genre FROM (SELECT kw, {_tokens('kw')} AS qt FROM "
        f"(SELECT DISTINCT kw FROM forms WHERE length(kw) >= 4)) q, (SELECT genre, ordinal, {_tokens('keyword')} AS kt FROM lut) k "
        "WHERE len(qt) > 0 AND len(kt) > 0 AND (list_has_all(kt, qt) OR list_has_all(qt, kt)) GROUP BY kw"
    ),
    "labels": (
        "SELECT f.keyword_norm, CASE WHEN f.kw = '' THEN 'UNKNOWN' ELSE coalesce(l.genre, "
        f"{_regex_genre('f.kw')}, s.genre, 'UNKNOWN') END AS derived_genre "
        "FROM forms f LEFT JOIN lut l ON l.keyword = f.kw LEFT JOIN subset_hits s ON s.kw = f.kw"
    ),
    "row_columns": f"""
      SELECT eventid AS event_id, event_ts, CAST(hour(event_ts + INTERVAL 7 HOUR) AS BIGINT) AS hour_of_day_vn,
        sha256(user_id) AS user_id_hashed, user_id IS NOT NULL AS user_is_authenticated,
        category AS session_action, category = 'quit' AS is_search_abandoned,
        lower(trim(keyword)) AS keyword_norm, keyword IS NULL AS keyword_is_null,
        {_platform('platform')} AS platform_group, {_network('networktype')} AS network_type_norm,
        upper(proxy_isp) AS isp_segment, {_premium('userplansmap')} AS has_premium,
        CAST(len(userplansmap) AS BIGINT) AS subscription_count,
        CASE WHEN user_id IS NOT NULL THEN user_id || '|' || bucket ELSE proxy_isp || '|' || platform || '|' || bucket END AS session_key,
        year(event_ts) <> try_cast(substr(dt, 1, 4) AS INT) AS is_cross_partition_date, dt
      FROM (SELECT *, CAST(CAST(floor(epoch(event_ts) / 1800) AS BIGINT) AS VARCHAR) AS bucket FROM repaired)""",
    "curated": """
      SELECT r.* EXCLUDE (session_key), sha256(session_key) AS search_session_id,
        coalesce(l.derived_genre, 'UNKNOWN') AS derived_genre,
        r.keyword_norm = last_value(r.keyword_norm IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY event_ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS is_repeat_search
      FROM row_columns r LEFT JOIN labels l USING (keyword_norm)""",
    "valid": "SELECT * FROM curated WHERE keyword_norm IS NOT NULL AND is_cross_partition_date = false",
    "daily_stats": """
      SELECT CAST(dt AS DATE) AS trend_date, derived_genre, platform_group, network_type_norm, isp_segment, keyword_norm,
        count(*) AS search_count, count(*) FILTER (WHERE session_action = 'enter') AS enter_count,
        1 - count(*) FILTER (WHERE session_action = 'enter') / CAST(count(*) AS DOUBLE) AS abandonment_rate,
        count(DISTINCT user_id_hashed) AS unique_users,
        count(DISTINCT user_id_hashed) / CAST(count(*) AS DOUBLE) AS authenticated_rate,
        avg(CAST(is_repeat_search AS INT)) AS repeat_search_rate, avg(CAST(has_premium AS INT)) AS premium_search_rate
      FROM valid WHERE dt >= '2024-01-01' GROUP BY ALL""",
    "counts_7d": """
      SELECT derived_genre, platform_group, keyword_norm, count(*) FILTER (WHERE session_action = 'enter') AS enter_count
      FROM valid WHERE dt BETWEEN '2024-01-23' AND '2024-01-29' GROUP BY ALL""",
    "ranked_today": f"SELECT *, rank() OVER (PARTITION BY {_SLOT} ORDER BY enter_count DESC) AS rank_today FROM daily_stats",
    "ranked_7d": f"SELECT *, rank() OVER (PARTITION BY {_SLOT} ORDER BY enter_count DESC) AS rank_7d_ago FROM counts_7d",
    "gold": f"""
      SELECT t.*, coalesce(h.rank_7d_ago, 9999) AS rank_7d_ago, coalesce(h.rank_7d_ago, 9999) - t.rank_today AS rank_delta
      FROM ranked_today t LEFT JOIN (SELECT {_SLOT}, keyword_norm, rank_7d_ago FROM ranked_7d) h
        USING ({_SLOT}, keyword_norm) WHERE t.rank_today <= 50""",
    "daily_counts": """
      SELECT derived_genre, hour_of_day_vn, dt, count(*) AS daily_enter_count FROM curated
      WHERE dt BETWEEN '2024-01-24' AND '2024-01-30' AND session_action = 'enter' AND is_cross_partition_date = false GROUP BY ALL""",
    "baseline": """
      SELECT derived_genre, hour_of_day_vn, derived_genre || '#' || hour_of_day_vn AS genre_hour,
        round(avg(daily_enter_count), 4) AS rolling_mean, round(stddev_pop(daily_enter_count), 4) AS rolling_std,
        count(*) AS sample_days FROM daily_counts GROUP BY ALL""",
    "day_buckets": """
      SELECT dt, derived_genre, hour_of_day_vn, count(*) AS observed_count FROM curated WHERE session_action = 'enter' GROUP BY ALL""",
    "scored": """
      SELECT *, abs(z_score) > 3 AS is_anomaly,
        CASE WHEN abs(z_score) > 3 THEN CASE WHEN z_score > 0 THEN 'SPIKE' ELSE 'DROP' END END AS anomaly_type
      FROM (SELECT b.*, coalesce(rolling_mean, 0) AS rolling_mean, coalesce(rolling_std, 0) AS rolling_std,
              (observed_count - coalesce(rolling_mean, 0)) / greatest(coalesce(rolling_std, 0), 1.0) AS z_score
            FROM day_buckets b LEFT JOIN (SELECT derived_genre, hour_of_day_vn, rolling_mean, rolling_std FROM baseline) s
              USING (derived_genre, hour_of_day_vn))""",
    "anomalies": """
      SELECT derived_genre || '#' || hour_of_day_vn || '#' || sha256(derived_genre || '|' || hour_of_day_vn || '|' || coalesce(dt, 'none')) AS anomaly_id,
        '2024-01-31T00:00:00Z' AS score_ts, derived_genre, hour_of_day_vn, observed_count,
        round(rolling_mean, 4) AS rolling_mean, round(rolling_std, 4) AS rolling_std, round(z_score, 4) AS z_score,
        is_anomaly, anomaly_type, 1706659200 + 2592000 AS ttl
      FROM scored WHERE is_anomaly""",
    "eval_keywords": """
      SELECT keyword_norm, derived_genre AS rules_genre, search_count FROM (
        SELECT keyword_norm, derived_genre, CAST(sum(search_count) AS BIGINT) AS search_count,
          row_number() OVER (PARTITION BY keyword_norm ORDER BY sum(search_count) DESC, derived_genre) AS rn
        FROM gold WHERE length(keyword_norm) >= 2 GROUP BY keyword_norm, derived_genre) WHERE rn = 1""",
    "oracle_labels": _fill(sql.ORACLE_LABELS).replace("FROM keywords", "FROM eval_keywords"),
    "adjudicated": _fill(sql.ADJUDICATED).replace("FROM keywords", "FROM eval_keywords"),
    "compared": """
      SELECT k.keyword_norm, k.rules_genre, coalesce(o.genre, 'UNKNOWN') AS oracle_genre,
        k.rules_genre = coalesce(o.genre, 'UNKNOWN') AS agree, k.search_count
      FROM eval_keywords k LEFT JOIN oracle_labels o USING (keyword_norm)""",
    "outcomes": f"""
      SELECT g.genre, count(c.kind) FILTER (WHERE kind = 'tp') AS tp, count(c.kind) FILTER (WHERE kind = 'fp') AS fp,
        count(c.kind) FILTER (WHERE kind = 'fn') AS fn,
        coalesce(sum(v) FILTER (WHERE kind = 'tp'), 0) AS tp_volume, coalesce(sum(v) FILTER (WHERE kind = 'fp'), 0) AS fp_volume,
        coalesce(sum(v) FILTER (WHERE kind = 'fn'), 0) AS fn_volume
      FROM {_DOMAIN} g(genre) LEFT JOIN (
        SELECT rules_genre AS genre, CASE WHEN agree THEN 'tp' ELSE 'fp' END AS kind, search_count AS v FROM compared
        UNION ALL SELECT oracle_genre, 'fn', search_count FROM compared WHERE NOT agree) c USING (genre) GROUP BY g.genre""",
    "prf": """
      SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1,
        CASE WHEN precision_volume + recall_volume > 0 THEN 2 * precision_volume * recall_volume / (precision_volume + recall_volume) ELSE 0 END AS f1_volume
      FROM (SELECT *, tp + fn AS support,
        CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
        CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall,
        CASE WHEN tp_volume + fp_volume > 0 THEN tp_volume / CAST(tp_volume + fp_volume AS DOUBLE) ELSE 0 END AS precision_volume,
        CASE WHEN tp_volume + fn_volume > 0 THEN tp_volume / CAST(tp_volume + fn_volume AS DOUBLE) ELSE 0 END AS recall_volume
        FROM outcomes)""",
    "fix_plan": f"""
      SELECT target, kw AS keyword, coalesce(lut_genre, ext_genre, 'regex') AS old_genre, oracle_genre AS new_genre, search_count FROM (
        SELECT *, row_number() OVER (PARTITION BY target, kw ORDER BY search_count, keyword_norm DESC) AS rn FROM (
          SELECT c.*, l.genre AS lut_genre, e.genre AS ext_genre,
            CASE WHEN l.genre IS NOT NULL THEN CASE WHEN search_count >= 200 THEN 'lut' END
                 WHEN e.genre IS NOT NULL THEN CASE WHEN search_count >= 50 THEN 'lut_ext' END
                 WHEN {_regex_genre('c.kw')} = rules_genre AND search_count >= 100 THEN 'lut' END AS target
          FROM (SELECT *, {_preprocess('keyword_norm')} AS kw FROM compared WHERE NOT agree AND oracle_genre <> 'UNKNOWN') c
            LEFT JOIN lut l ON l.keyword = c.kw LEFT JOIN lut_ext e ON e.keyword = c.kw
          WHERE c.keyword_norm NOT IN ({', '.join(map(_q, LABELLER_MISTAKES))}) AND c.kw NOT IN ({', '.join(map(_q, LABELLER_MISTAKES))}))
        WHERE target IS NOT NULL) WHERE rn = 1""",
    "cases": f"""
      SELECT c.keyword_norm, CASE WHEN agree THEN rules_genre WHEN a.genre IN ({', '.join(map(_q, GENRES))}) THEN a.genre
          ELSE rules_genre END AS expected_genre, search_count,
        CASE WHEN agree THEN 'high' ELSE 'adjudicated' END AS confidence,
        CASE WHEN agree THEN 'agree' ELSE 'adjudicator' END AS source
      FROM compared c LEFT JOIN adjudicated a USING (keyword_norm)""",
    "metrics": _fill(sql.METRICS),
    # Hours that are over when the last event has come and the watermark has passed; the late rows do not count.
    "windows": """
      SELECT CAST(epoch_ms(date_trunc('hour', event_ts)) AS BIGINT) AS window_start, derived_genre, hour_of_day_vn, count(*) AS observed_count
      FROM curated WHERE session_action = 'enter' AND year(event_ts) = 2024 AND NOT (day(event_ts) = 3 AND CAST(event_id AS BIGINT) % 10 = 0) GROUP BY ALL""",
    "closed": """
      SELECT w.*, round((observed_count - coalesce(rolling_mean, 0)) / greatest(coalesce(rolling_std, 0), 1.0), 6) AS z
      FROM windows w LEFT JOIN (SELECT derived_genre, hour_of_day_vn, rolling_mean, rolling_std FROM baseline) b USING (derived_genre, hour_of_day_vn)
      WHERE window_start + 3600000 <= (SELECT epoch_ms(max(event_ts)) - 3600000 FROM curated WHERE session_action = 'enter')""",
}
_WORDS = re.compile(r"\b(" + "|".join(TABLES) + r")\b")


def _needs(text: str) -> set[str]:
    found: set[str] = set()
    todo = set(re.findall(r"(?:FROM|JOIN|,)\s+\(?\s*(\w+)", text)) & TABLES.keys()
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo |= set(_WORDS.findall(TABLES[name])) - {name}
    return found


def with_tables(body: str) -> str:
    """``body`` with the common tables it uses as CTEs."""
    need = _needs(body)
    ctes = [f"{name} AS MATERIALIZED ({text.strip()})" for name, text in TABLES.items() if name in need]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
