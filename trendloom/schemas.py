"""Table schemas. Partition keys stay STRING: inference would turn ``dt`` into DATE and ``hour`` into INT."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL(18,4)": T.DecimalType(18, 4),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def _fields(text: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; unlike ``fromDDL`` it needs no running session."""
    pairs = (item.split() for item in text.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_DATA = _fields(
    "eventid STRING, datetime STRING, user_id STRING, keyword STRING, category STRING, "
    "proxy_isp STRING, platform STRING, networktype STRING, action STRING, userplansmap ARRAY<STRING>"
)
RAW_PARTITIONS = _fields("dt STRING, hour STRING, derived_genre STRING, platform_group STRING")
RAW_EVENTS = T.StructType(RAW_DATA.fields + RAW_PARTITIONS.fields)

STREAM_EVENT = T.StructType(
    RAW_DATA.fields
    + _fields(
        "datetime_clean STRING, keyword_norm STRING, derived_genre STRING, platform_group STRING"
    ).fields
)

CURATED = _fields(
    "event_id STRING, event_ts TIMESTAMP, hour_of_day_vn INT, user_id_hashed STRING, "
    "user_is_authenticated BOOLEAN, session_action STRING, is_search_abandoned BOOLEAN, "
    "keyword_norm STRING, keyword_is_null BOOLEAN, derived_genre STRING, platform_group STRING, "
    "network_type_norm STRING, isp_segment STRING, has_premium BOOLEAN, subscription_count INT, "
    "search_session_id STRING, is_repeat_search BOOLEAN, is_cross_partition_date BOOLEAN, dt STRING"
)
GOLD = _fields(
    "platform_group STRING, network_type_norm STRING, isp_segment STRING, keyword_norm STRING, "
    "search_count BIGINT, enter_count BIGINT, abandonment_rate DOUBLE, unique_users BIGINT, "
    "authenticated_rate DOUBLE, repeat_search_rate DOUBLE, premium_search_rate DOUBLE, "
    "rank_today BIGINT, rank_7d_ago BIGINT, rank_delta BIGINT, trend_date DATE, derived_genre STRING"
)
BASELINE = _fields(
    "genre_hour STRING, derived_genre STRING, hour_of_day_vn INT, rolling_mean DECIMAL(18,4), "
    "rolling_std DECIMAL(18,4), sample_days INT, updated_at STRING"
)
LOOKUP = _fields("keyword STRING, genre STRING, ordinal BIGINT")
METRIC = _fields("metric_name STRING, dimensions MAP<STRING,STRING>, value DOUBLE, unit STRING")

# The closed domains.
GENRES = (
    "NHAC", "THE_THAO", "ANIME", "PHIM_TRUNG", "PHIM_VIET",
    "PHIM_AU_MY", "PHIM_HAN", "TRUYEN_HINH", "UNKNOWN",
)
UNKNOWN = "UNKNOWN"
PLATFORMS = ("OTTBox", "SmartTV", "Android", "iOS", "Web", "Other")
