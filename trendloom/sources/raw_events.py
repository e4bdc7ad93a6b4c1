"""Reading raw search events: partitioned table, loose source files, encoded stream records."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.schemas import RAW_EVENTS, STREAM_EVENT


@dataclass(frozen=True)
class DateWindow:
    """Closed range of ``dt`` partition values. Literals, so the scan prunes partitions."""

    start: str | None = None
    end: str | None = None

    @classmethod
    def last_days(cls, as_of: date, days: int = 2) -> DateWindow:
        """Everything from ``days`` before ``as_of`` on."""
        return cls(start=(as_of - timedelta(days=days)).isoformat())

    @classmethod
    def trailing(cls, as_of: date, first: int = 7, last: int = 1, start: str | None = None) -> DateWindow:
        """From ``first`` to ``last`` days before ``as_of``; a fixed ``start`` leaves the end open."""
        if start:
            return cls(start=start)
        return cls((as_of - timedelta(days=first)).isoformat(), (as_of - timedelta(days=last)).isoformat())

    def covers(self, dt: Column) -> Column:
        test = F.lit(True)
        if self.start:
            test = dt >= self.start
        if self.end:
            test = (dt <= self.end) if not self.start else dt.between(self.start, self.end)
        return test


def scan_raw_events(spark: SparkSession, path: str, window: DateWindow | None = None) -> DataFrame:
    """Partitioned raw table, restricted to the partitions of ``window``."""
    df = (
        spark.read.schema(RAW_EVENTS)
        .option("basePath", path)
        .option("mergeSchema", "false")
        .parquet(path)
    )
    return df.where(window.covers(F.col("dt"))) if window else df


def scan_source_files(spark: SparkSession, prefix: str, schema: T.StructType | None = None) -> DataFrame:
    """All ``*.parquet`` files under ``prefix`` at any depth; unreadable files are skipped."""
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "true")
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(prefix).withColumn("source_file", F.input_file_name())


def file_modal_date(df: DataFrame, file_col: str = "source_file", dt_col: str = "datetime") -> DataFrame:
    """Most common date of each file, dashes removed; files without any date are left out.

    Counting per (file, date) first keeps the shuffle at one row per pair. Ties go to the
    smallest date.
    """
    day = F.regexp_replace(F.left(F.col(dt_col), F.lit(10)), "-", "")
    counts = (
        df.where(F.length(dt_col) >= 10)
        .groupBy(F.col(file_col), day.alias("modal_date"))
        .agg(F.count("*").alias("n"))
    )
    return (
        counts.groupBy(file_col)
        .agg(F.min(F.struct((-F.col("n")).alias("rank"), "modal_date")).alias("best"))
        .select(file_col, "best.modal_date")
    )


def decode_json_records(
    df: DataFrame, col: str = "data", schema: T.StructType = STREAM_EVENT
) -> tuple[DataFrame, DataFrame]:
    """Base64 JSON to columns. Returns (good rows, dead letters with the raw value)."""
    text = F.expr(f"try_to_binary({col}, 'base64')").cast("string")
    wide = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_event", F.from_json(text, wide, options))
    bad = F.col("_event").isNull() | F.col("_event._corrupt").isNotNull()
    good = parsed.where(~bad).select([F.col("_event")[f.name].alias(f.name) for f in schema.fields])
    return good, parsed.where(bad).select(F.col(col))
