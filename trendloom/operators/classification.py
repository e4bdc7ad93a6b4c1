"""Keyword to genre, as a set-oriented job over distinct keywords.

Stages, each only for what the ones before left open: curated lookup, extended lookup, extended
lookup without diacritics, regex patterns, similarity with the curated lookup, similarity with
the extended lookup, optional model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions.genres import regex_genre
from trendloom.functions.text import preprocess_keyword, strip_diacritics
from trendloom.operators.similarity import fuzzy_ext_join, fuzzy_join
from trendloom.operators.skew import salted_left_join
from trendloom.schemas import UNKNOWN
from trendloom.session import stage

Labeller = Callable[[DataFrame], DataFrame]


def lut_exact_join(keywords: DataFrame, lut: DataFrame, name: str = "lut_genre") -> DataFrame:
    """Add the lookup's genre for ``kw``. A hit of UNKNOWN is a hit; an empty genre is not."""
    right = lut.select(F.col("keyword").alias("kw"), F.nullif("genre", F.lit("")).alias(name))
    return keywords.join(right, "kw", "left")


def nodiac_index(lut_ext: DataFrame) -> DataFrame:
    """Lookup keyed without diacritics; of colliding keys the last in file order counts."""
    return (
        lut_ext.groupBy(strip_diacritics(F.col("keyword")).alias("keyword"))
        .agg(F.max_by("genre", "ordinal").alias("genre"))
    )


def lut_nodiac_join(keywords: DataFrame, lut_ext: DataFrame, name: str = "nodiac_genre") -> DataFrame:
    right = nodiac_index(lut_ext).select(F.col("keyword").alias("_plain"), F.nullif("genre", F.lit("")).alias(name))
    return keywords.withColumn("_plain", strip_diacritics(F.col("kw"))).join(right, "_plain", "left").drop("_plain")


def rule_stages(keywords: DataFrame, lut: DataFrame, lut_ext: DataFrame | None = None) -> DataFrame:
    """Lookup and regex stages: (…, kw, genre, stage), genre null where all of them fail.

    Works row by row with static lookups, so streams can use it too.
    """
    df = keywords.withColumn("kw", preprocess_keyword(F.col("keyword_norm")))
    df = lut_exact_join(df, lut)
    found = [("lut", F.col("lut_genre"))]
    if lut_ext is not None:
        df = lut_nodiac_join(lut_exact_join(df, lut_ext, "ext_genre"), lut_ext)
        found += [("lut_ext", F.col("ext_genre")), ("nodiac", F.col("nodiac_genre"))]
    empty = F.coalesce(F.col("kw") == "", F.lit(True))
    by_lookup = F.coalesce(*[genre for _, genre in found])
    df = df.withColumn(
        "genre", F.when(empty, F.lit(UNKNOWN)).otherwise(F.coalesce(by_lookup, regex_genre(F.col("kw"))))
    )
    label = F.when(empty, F.lit("empty"))
    for name, genre in found:
        label = label.when(genre.isNotNull(), F.lit(name))
    df = df.withColumn("stage", label.when(F.col("genre").isNotNull(), F.lit("regex")))
    return df.drop("lut_genre", "ext_genre", "nodiac_genre")


def _settle(df: DataFrame, hits: DataFrame, name: str) -> DataFrame:
    """Take the genre of ``hits`` (kw, genre) for rows still open."""
    hits = hits.select("kw", F.col("genre").alias("_genre"))
    return (
        df.join(hits, "kw", "left")
        .withColumn("stage", F.coalesce("stage", F.when(F.col("_genre").isNotNull(), F.lit(name))))
        .withColumn("genre", F.coalesce("genre", "_genre"))
        .drop("_genre")
    )


def classify_keywords(
    keywords: DataFrame,
    lut: DataFrame,
    lut_ext: DataFrame | None = None,
    fuzzy: bool = True,
    fuzzy_ext: bool = False,
    model: Labeller | None = None,
) -> DataFrame:
    """(keyword_norm, derived_genre, stage) plus other columns of ``keywords``.

    ``keywords`` has one row per ``keyword_norm``. The rule stages are written to the shared
    folder once, as the later stages read their residue several times over.
    """
    df = rule_stages(keywords, lut, lut_ext)
    if fuzzy or fuzzy_ext or model:
        df = stage(df, "rules")
    if fuzzy:
        df = _settle(df, fuzzy_join(df.where("genre IS NULL"), lut), "fuzzy")
    if fuzzy_ext and lut_ext is not None:
        df = stage(df, "fuzzy") if fuzzy else df
        df = _settle(df, fuzzy_ext_join(df.where("genre IS NULL"), lut_ext), "fuzzy_ext")
    if model:
        labels = model(df.where("genre IS NULL").select("kw").distinct()).where(F.col("genre") != UNKNOWN)
        df = _settle(df, labels, "model")
    return (
        df.withColumn("derived_genre", F.coalesce("genre", F.lit(UNKNOWN)))
        .withColumn("stage", F.coalesce("stage", F.lit("none")))
        .drop("kw", "genre")
    )


def with_genre(events: DataFrame, labels: DataFrame, id_col: str = "event_id", hot_rows: int | None = None) -> DataFrame:
    """Join the labels of distinct keywords back to the events; unlabelled events become UNKNOWN.

    ``labels`` is (keyword_norm, derived_genre, n), n being the number of events.
    """
    joined = salted_left_join(
        events,
        labels.select("keyword_norm", "derived_genre", "n"),
        "keyword_norm",
        F.col(id_col),
        dim_rows="n",
        min_rows=hot_rows,
    )
    return joined.withColumn("derived_genre", F.coalesce("derived_genre", F.lit(UNKNOWN))).drop("n")


def distinct_keywords(events: DataFrame) -> DataFrame:
    """Distinct non-null keywords with their number of events, counted before the shuffle."""
    return events.where(F.col("keyword_norm").isNotNull()).groupBy("keyword_norm").agg(F.count("*").alias("n"))


def lut_unknown_fallback(df: DataFrame, combined: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Look up the rows still UNKNOWN in ``combined`` (keyword, genre); other rows keep their genre.

    The open keywords are counted and looked up once each; their counts tell which are hot. Rows with
    nothing to look up get a null key, so the salted join spreads them.
    """
    open_row = F.col("derived_genre") == UNKNOWN
    counted = df.where(open_row & F.col("keyword_norm").isNotNull()).groupBy(F.col("keyword_norm").alias("_kw")).agg(F.count("*").alias("_n"))
    known = combined.select(F.col("keyword").alias("_kw"), F.col("genre").alias("_genre"))
    found = stage(counted.join(known, "_kw"), "fallback")
    keyed = df.withColumn("_kw", F.when(open_row, F.col("keyword_norm")))
    joined = salted_left_join(keyed, found, "_kw", F.struct(*df.columns), dim_rows="_n", min_rows=hot_rows)
    return joined.withColumn("derived_genre", F.coalesce("_genre", "derived_genre")).select(*df.columns)


def unknown_top_keywords(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent keywords still UNKNOWN; equal counts in keyword order."""
    return (
        df.where((F.col("derived_genre") == UNKNOWN) & F.col("keyword_norm").isNotNull())
        .groupBy("keyword_norm")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "keyword_norm")
        .limit(n)
    )


def new_keywords_anti(keywords: DataFrame, known: DataFrame) -> DataFrame:
    """Keywords not yet in the lookup ``known``."""
    return keywords.join(known.select(F.col("keyword").alias("keyword_norm")), "keyword_norm", "left_anti")


def distinct_unknown_keywords(df: DataFrame) -> DataFrame:
    return df.where((F.col("derived_genre") == UNKNOWN) & (F.col("keyword_norm") != "")).select("keyword_norm").distinct()
