"""Who may read what, personal-data scan, and data-quality counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import timestamps
from trendloom.functions.text import strip

# Gold columns open to marketing.
MARKETING_COLUMNS = (
    "keyword_norm", "search_count", "enter_count", "abandonment_rate", "rank_today", "rank_delta",
    "trend_date", "derived_genre", "platform_group", "network_type_norm", "isp_segment",
)
# Layers open to each role; None stands for all columns.
GRANTS: Mapping[str, Mapping[str, Sequence[str] | None]] = {
    "engineering": {"raw": None, "curated": None, "gold": None},
    "analyst": {"curated": None, "gold": None},
    "marketing": {"gold": MARKETING_COLUMNS},
}
# Fixed value: phone number with +84 or 0 in front of nine digits.
PII_PATTERNS = {"vn_phone": r"(0|\+84)[0-9]{9}"}


def role_view(
    df: DataFrame, layer: str, role: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """``df`` as ``role`` may see it; asking for a closed layer or column raises PermissionError."""
    layers = GRANTS.get(role, {})
    if layer not in layers:
        raise PermissionError(f"{role} may not read {layer}")
    allowed = layers[layer]
    open_columns = list(df.columns) if allowed is None else [c for c in df.columns if c in allowed]
    wanted = list(columns) if columns else open_columns
    closed = [c for c in wanted if c not in open_columns]
    if closed:
        raise PermissionError(f"{role} may not read {layer}.{', '.join(closed)}")
    return df.select(*wanted)


def register_role_views(spark: SparkSession, tables: Mapping[str, DataFrame], role: str) -> list[str]:
    """Temporary view ``<role>_<layer>`` for each layer open to ``role``."""
    names = []
    for layer, df in tables.items():
        if layer in GRANTS.get(role, {}):
            names.append(f"{role}_{layer}")
            role_view(df, layer, role).createOrReplaceTempView(names[-1])
    return names


def pii_scan(df: DataFrame, patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """(pattern, column, rows_scanned, rows_hit, matches, sample) for each text column, in one pass.

    Arrays of texts count as texts, their entries joined by line breaks. ``sample`` is the smallest match, null
    without any.
    """
    joined = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            joined[f.name] = F.col(f"`{f.name}`")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            joined[f.name] = F.array_join(F.col(f"`{f.name}`"), "\n")
    checks = [(p, name) for p in patterns for name in joined]
    aggs = []
    for i, (pattern, column) in enumerate(checks):
        found = F.regexp_extract_all(joined[column], F.lit(patterns[pattern]), F.lit(0))
        aggs += [
            F.count_if(F.size(found) > 0).alias(f"hit_{i}"),
            F.coalesce(F.sum(F.when(found.isNotNull(), F.size(found))), F.lit(0)).cast("bigint").alias(f"all_{i}"),
            F.min(F.array_min(found)).alias(f"sample_{i}"),
        ]
    totals = df.agg(F.count("*").alias("rows_scanned"), *aggs)
    cells = [
        F.struct(
            F.lit(p).alias("pattern"),
            F.lit(name).alias("column"),
            F.col("rows_scanned"),
            F.col(f"hit_{i}").alias("rows_hit"),
            F.col(f"all_{i}").alias("matches"),
            F.col(f"sample_{i}").alias("sample"),
        )
        for i, (p, name) in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*cells)))


def dq_profile(raw: DataFrame) -> DataFrame:
    """Rows per kind of timestamp damage."""
    text = strip(F.col("datetime"))
    ts = timestamps.parse_event_ts(timestamps.clean_datetime(F.col("datetime")))
    return raw.select("datetime", "dt", text.alias("text"), ts.alias("ts")).agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("datetime").isNull()).alias("missing"),
        F.count_if(F.col("text").rlike("[٠-٩]")).alias("arabic_digits"),
        F.count_if(F.col("text").rlike("[۰-۹]")).alias("extended_arabic_digits"),
        F.count_if(F.col("text").startswith("2565")).alias("buddhist_year"),
        F.count_if(F.year("ts") < 2015).alias("corrupt_year"),
        F.count_if(F.col("datetime").isNotNull() & F.col("ts").isNull()).alias("unparseable"),
        F.count_if(
            timestamps.plausible_year(F.col("ts")) & timestamps.cross_partition_date(F.col("ts"), F.col("dt"))
        ).alias("cross_partition"),
    )
