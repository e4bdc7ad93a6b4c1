"""The fixture tables as Spark DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.fixtures import sql
from trendloom.operators import anomalies, evaluation, trends
from trendloom.plans.enrichment import curate
from trendloom.session import stage
from trendloom.sources.lookups import load_lookup
from trendloom.sources.raw_events import DateWindow

AS_OF = date(2024, 1, 31)
ALL_DAYS = DateWindow(start="2024-01-01")

Table = Callable[[SparkSession, str], DataFrame]
_written: dict[tuple[str, str, str], DataFrame] = {}


def _written_once(make: Table) -> Table:
    """Keep the table in the shared folder for the session: one layer's output is the next one's input."""

    @wraps(make)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
        if key not in _written:
            _written[key] = stage(make(spark, sf_dir), make.__name__)
        return _written[key]

    return read


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_written_once
def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer, spread over several files as a stream sink would leave it."""
    return fresh_search_log(spark, sf_dir).repartition("eventid")


def fresh_search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(sql.SEARCH_LOG, events=source(spark, sf_dir, "events"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(sql.TITLES, pages=source(spark, sf_dir, "pages"))


def lut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_lookup(spark)


def lut_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(sql.LUT_EXT, titles=titles(spark, sf_dir), search_log=search_log(spark, sf_dir))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = source(spark, sf_dir, "conversations")
    return turns.select(F.explode(F.split("text", "[.]")).alias("sentence"))


def keyword_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        sql.KEYWORD_POOL,
        search_log=search_log(spark, sf_dir),
        part=source(spark, sf_dir, "part"),
        titles=titles(spark, sf_dir),
        sentences=sentences(spark, sf_dir),
    )


def fresh_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(search_log(spark, sf_dir), lut(spark, sf_dir))


@_written_once
def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_curated(spark, sf_dir)


def fresh_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.keyword_trends(curated(spark, sf_dir), AS_OF, ALL_DAYS)


@_written_once
def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_gold(spark, sf_dir)


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.baseline(curated(spark, sf_dir), AS_OF)


def eval_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.eval_keywords(gold(spark, sf_dir), include_unknown=True)


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    keywords = eval_keywords(spark, sf_dir)
    return evaluation.eval_compare(keywords, spark.sql(sql.ORACLE_LABELS, keywords=keywords))


def adjudicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(sql.ADJUDICATED, keywords=eval_keywords(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(sql.METRICS, events=source(spark, sf_dir, "events"))
