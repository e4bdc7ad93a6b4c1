"""Keyword lookups: JSON maps as two-column tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions.text import strip
from trendloom.schemas import LOOKUP, UNKNOWN
from trendloom.sources.sinks import exists, publish_version, resolve_version, update_version

SEED_LOOKUP = str(Path(__file__).parent.parent / "data" / "seed_lookup.json")


def empty_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOOKUP)


def load_lookup(spark: SparkSession, path: str = SEED_LOOKUP) -> DataFrame:
    """(keyword, genre, ordinal) from a JSON object; ``ordinal`` is the entry's place in the file.

    A missing file gives an empty lookup; any other trouble is raised. ``path`` may be a folder written by
    ``write_lookup``, which is the form for large lookups: a JSON file is one record, read by one task.
    """
    if not path.endswith(".json"):
        version = resolve_version(spark, path)
        return spark.read.schema(LOOKUP).parquet(version) if version else empty_lookup(spark)
    if not exists(spark, path):
        return empty_lookup(spark)
    text = spark.read.text(path, wholetext=True)
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    return text.select(F.posexplode(entries).alias("ordinal", "e")).select(
        F.col("e.key").alias("keyword"),
        F.col("e.value").alias("genre"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )


def merge_lookup(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Union of two lookups, the update winning; UNKNOWN entries are dropped.

    If the updates hold a keyword several times, the first genre by name that is not UNKNOWN counts.
    """
    genre = F.coalesce(F.min(F.when(F.col("genre") != UNKNOWN, F.col("genre"))), F.min("genre"))
    new = updates.groupBy("keyword").agg(genre.alias("new_genre"))
    return (
        existing.select("keyword", F.col("genre").alias("old_genre"))
        .join(new, "keyword", "full_outer")
        .select("keyword", F.coalesce("new_genre", "old_genre").alias("genre"))
        .where(F.col("genre") != UNKNOWN)
    )


def write_lookup(df: DataFrame, root: str) -> str:
    """Write a new version sorted by keyword, then point readers at it.

    Ids given after the sort grow with it, so they serve as the file order.
    """
    return publish_version(_numbered(df), root)


def update_lookup(updates: DataFrame, root: str) -> str:
    """Merge ``updates`` (keyword, genre) into the newest version under ``root``; no update is lost to a writer at the same time."""
    spark = updates.sparkSession

    def merged(version: str | None) -> DataFrame:
        existing = spark.read.schema(LOOKUP).parquet(version) if version else empty_lookup(spark)
        return _numbered(merge_lookup(existing, updates))

    return update_version(spark, root, merged)


def _numbered(df: DataFrame) -> DataFrame:
    return df.select("keyword", "genre").orderBy("keyword").withColumn("ordinal", F.monotonically_increasing_id())


def read_keyword_csv(
    spark: SparkSession, path: str, known: DataFrame | None = None, limit: int | None = None, multi_line: bool = False
) -> DataFrame:
    """``keyword_norm`` column of a CSV, unquoted, without empty or already known keywords.

    ``limit`` keeps the first keywords in order. ``multi_line`` allows line breaks inside keywords; each file is
    then read by one task.
    """
    raw = spark.read.csv(path, header=True, escape='"', multiLine=multi_line)
    keyword = F.regexp_replace(strip(F.col("keyword_norm")), '^"+|"+$', "")
    rows = raw.select(keyword.alias("keyword_norm")).where(F.col("keyword_norm") != "")
    if known is not None:
        rows = rows.join(known.select(F.col("keyword").alias("keyword_norm")), "keyword_norm", "left_anti")
    return rows if limit is None else rows.orderBy("keyword_norm").limit(limit)
