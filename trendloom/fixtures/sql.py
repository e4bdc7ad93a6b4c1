"""Portable SQL of the fixture tables; Spark and DuckDB run the same text."""

from __future__ import annotations

# Raw search log made of ``events``, with every kind of damage the enrichment has to repair.
SEARCH_LOG = """
SELECT eventid, datetime, user_id, keyword, category, proxy_isp, platform, networktype, action, userplansmap,
       substr(datetime, 1, 10) AS dt, substr(datetime, 12, 2) AS hour
FROM (
  SELECT eventid,
    CASE event_id % 50
      WHEN 7  THEN translate(iso, '0123456789', '٠١٢٣٤٥٦٧٨٩')
      WHEN 11 THEN translate(iso, '0123456789', '۰۱۲۳۴۵۶۷۸۹')
      WHEN 13 THEN '2565' || substr(iso, 5)
      WHEN 17 THEN '0004' || substr(iso, 5)
      WHEN 19 THEN substr(iso, 1, 11) || '6' || substr(iso, 14) || ' CH'
      WHEN 23 THEN NULL
      WHEN 29 THEN substr(iso, 1, 19)
      WHEN 31 THEN 'not a date'
      ELSE iso END AS datetime,
    user_id, keyword, category, proxy_isp, platform, networktype, action, userplansmap
  FROM (
    SELECT event_id, CAST(event_id AS STRING) AS eventid,
      CAST(year(ts) AS STRING) || '-' || lpad(CAST(month(ts) AS STRING), 2, '0') || '-' || lpad(CAST(day(ts) AS STRING), 2, '0')
        || ' ' || lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') || ':'
        || lpad(CAST(CAST(second(ts) AS INT) AS STRING), 2, '0') || '.' || lpad(CAST(event_id % 1000 AS STRING), 3, '0') AS iso,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
      CASE WHEN event_id % 31 = 0 THEN NULL ELSE split_part(
        'Bóng Đá|bong da| nhạc vàng |Bolero|naruto|one piece tap 12|[VietSub] why her|conan (2024)|vtv3|VTV3|phim hàn|tây du ký|avengers|marvel|k+|goooooal|xyzzy|the|phim a|nhạc trẻ remix|running man|kiếm hiệp|phim việt|a',
        '|', CAST((event_id * 7 + user_id) % 24 AS INT) + 1) END AS keyword,
      CASE WHEN event_type = 'error' THEN 'quit' ELSE 'enter' END AS category,
      CASE WHEN user_id % 11 = 0 THEN NULL ELSE split_part('vnpt|Viettel|CMC|mobifone', '|', CAST(user_id % 4 AS INT) + 1) END AS proxy_isp,
      CASE WHEN event_id % 37 = 0 THEN NULL ELSE split_part(
        'fplay-ottbox-2019|androidtvboxhis22|smarttv-lg|Smart-TV-Samsung|android|vsmart|iOS|web-player|fplay-gr-android-box|box2018|Android TV|WEB', '|', CAST(event_id % 12 AS INT) + 1) END AS platform,
      CASE WHEN event_id % 41 = 0 THEN NULL ELSE split_part('wifi|WLAN|wwan|4G|5g|Ethernet|CAB|cable|###|NO-INTERNET', '|', CAST(event_id % 10 AS INT) + 1) END AS networktype,
      event_type AS action,
      CASE WHEN event_id % 4 = 0 OR user_id % 6 = 0 THEN NULL
           ELSE split(split_part('VIP:1;SPORT:2|K+|basic|MAX XMAS : 3|HBO GO+:9;VIP:1', '|', CAST(user_id % 5 AS INT) + 1), ';') END AS userplansmap
    FROM {events}) a) b
"""

# Title catalogue in the role of the extended lookup: page titles and half of the searched keywords.
_GENRES8 = "'NHAC|THE_THAO|ANIME|PHIM_TRUNG|PHIM_VIET|PHIM_AU_MY|PHIM_HAN|TRUYEN_HINH'"
TITLES = """
SELECT page_id, lower(trim(regexp_extract(html, '<title>([^<]*)</title>', 1))) AS title FROM {pages}
"""
LUT_EXT = f"""
SELECT title AS keyword, split_part({_GENRES8}, '|', CAST(min(page_id) % 8 AS INT) + 1) AS genre, min(page_id) AS ordinal
FROM {{titles}} WHERE title <> '' GROUP BY title
UNION ALL
SELECT kw, split_part({_GENRES8}, '|', CAST(length(kw) % 8 AS INT) + 1), 1000000000000 + min(CAST(eventid AS BIGINT))
FROM (SELECT lower(trim(keyword)) AS kw, eventid FROM {{search_log}}) s
WHERE length(kw) % 2 = 0 GROUP BY kw
UNION ALL SELECT CASE WHEN count(*) >= 0 THEN 'トラコンホール カンタム' END, 'ANIME', 2000000000000 + count(*) FROM {{titles}}
"""

# Free-text keywords: searches, product names, titles as they are and with one letter left out,
# the sentences of messages, and titles written with marks that compose beyond Latin letters.
KEYWORD_POOL = """
SELECT keyword_norm, count(*) AS n FROM (
  SELECT lower(trim(keyword)) AS keyword_norm FROM {search_log}
  UNION ALL SELECT lower(p_name) FROM {part}
  UNION ALL SELECT title FROM {titles}
  UNION ALL SELECT substr(title, 1, CAST(page_id % length(title) AS INT)) || substr(title, CAST(page_id % length(title) AS INT) + 2)
            FROM {titles} WHERE title <> ''
  UNION ALL SELECT lower(trim(sentence)) FROM {sentences}
  UNION ALL SELECT split_part('ドラゴンボール ガンダム|ポケットモンスター|パパ|ё й ї', '|', CAST(page_id % 4 AS INT) + 1) FROM {titles}
) k WHERE keyword_norm <> '' GROUP BY keyword_norm
"""

# An independent labeller's verdicts on evaluated keywords: some agree, some differ, some lack.
ORACLE_LABELS = """
SELECT keyword_norm, CASE WHEN length(keyword_norm) % 3 = 0 THEN rules_genre ELSE split_part(
  'NHAC|THE_THAO|ANIME|PHIM_TRUNG|PHIM_VIET|PHIM_AU_MY|PHIM_HAN|TRUYEN_HINH|UNKNOWN', '|', CAST(length(keyword_norm) % 9 AS INT) + 1) END AS genre
FROM {keywords} WHERE length(keyword_norm) % 7 <> 0
"""
ADJUDICATED = """
SELECT keyword_norm, split_part('ANIME|NONSENSE|NHAC|PHIM_HAN', '|', CAST(length(keyword_norm) % 4 AS INT) + 1) AS genre
FROM {keywords} WHERE length(keyword_norm) % 5 <> 0
"""

# Operational metric points.
METRICS = """
SELECT 'Invocations' AS metric_name, CAST(ts AS TIMESTAMP) AS ts, CAST(1 AS DOUBLE) AS value FROM {events}
UNION ALL SELECT 'Errors', CAST(ts AS TIMESTAMP), CAST(1 AS DOUBLE) FROM {events} WHERE event_type = 'error'
UNION ALL SELECT 'AnomalyScore', CAST(ts AS TIMESTAMP), value / 10 FROM {events} WHERE event_type = 'click'
UNION ALL SELECT 'DailyPipelineSuccess', CAST(ts AS TIMESTAMP), CAST(1 AS DOUBLE) FROM {events} WHERE event_type = 'signup'
UNION ALL SELECT 'GetRecords.IteratorAgeMilliseconds', CAST(ts AS TIMESTAMP), value * 1000 FROM {events} WHERE event_type = 'view'
"""
