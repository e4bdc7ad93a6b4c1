"""Auditing and repairing the lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions.genres import STRONG_GENRES, regex_genre
from trendloom.functions.text import preprocess_keyword
from trendloom.schemas import UNKNOWN

# Keywords the labeller is known to get wrong.
LABELLER_MISTAKES = (
    "lưỡi gươm diệt quỷ",
    "học viện anh hùng",
    "cô nàng trong trắng oh woo ri",
    "shooting stars",
    "runningman",
    "running",
    "youtube",
    "trực tiếp bong da",
    "truc tiep bong da",
    "cá mập con baby shark dance | + tuyển tập | pinkfong! - nhạc thiếu nhi",
)
# Corrections made whatever the labeller says.
DIRECT_FIXES = {
    "lưỡi gươm diệt quỷ": "ANIME",
    "shooting stars": "PHIM_HAN",
    "cô nàng trong trắng oh woo ri": "PHIM_HAN",
    "runningman": "TRUYEN_HINH",
}


def lookup_conflicts(lut_ext: DataFrame) -> DataFrame:
    """Lookup entries whose first strong pattern points to another genre."""
    strong = regex_genre(F.col("keyword"), STRONG_GENRES)
    return lut_ext.select("keyword", F.col("genre").alias("lut_genre"), strong.alias("regex_genre")).where(
        F.col("regex_genre") != F.col("lut_genre")
    )


def conflict_breakdown(conflicts: DataFrame) -> DataFrame:
    return conflicts.groupBy("lut_genre", "regex_genre").agg(F.count("*").alias("entries"))


def fix_conflicts(lut_ext: DataFrame) -> DataFrame:
    """The lookup with the strong pattern's genre where there is a conflict."""
    strong = regex_genre(F.col("keyword"), STRONG_GENRES)
    return lut_ext.withColumn("genre", F.coalesce(strong, "genre"))


def plan_lookup_fixes(
    compared: DataFrame,
    lut: DataFrame,
    lut_ext: DataFrame,
    skip: Sequence[str] = LABELLER_MISTAKES,
    lut_min_volume: int = 5000,
    ext_min_volume: int = 100,
    promote_min_volume: int = 200,
) -> DataFrame:
    """(target, keyword, old_genre, new_genre, search_count) changes the labeller's disagreements suggest.

    Entries of the curated lookup change only at a very high volume, entries of the extended one
    at ``ext_min_volume``; a keyword classified by a pattern is promoted to the curated lookup.
    Several keywords may come down to one entry: the last in descending volume decides, as it is
    the last to be written. Keywords in ``skip``, the labeller's known mistakes, are left alone.
    """
    kw = preprocess_keyword(F.col("keyword_norm"))
    rows = compared.where(~F.col("agree") & (F.col("oracle_genre") != UNKNOWN)).withColumn("kw", kw)
    if skip:
        rows = rows.where(~F.col("keyword_norm").isin(*skip) & ~F.col("kw").isin(*skip))
    rows = (
        rows.join(lut.select(F.col("keyword").alias("kw"), F.col("genre").alias("_lut")), "kw", "left")
        .join(lut_ext.select(F.col("keyword").alias("kw"), F.col("genre").alias("_ext")), "kw", "left")
    )
    volume, in_lut, in_ext = F.col("search_count"), F.col("_lut").isNotNull(), F.col("_ext").isNotNull()
    by_pattern = ~in_lut & ~in_ext & (regex_genre(F.col("kw")) == F.col("rules_genre"))
    target = (
        F.when(in_lut, F.when(volume >= lut_min_volume, "lut"))
        .when(in_ext, F.when(volume >= ext_min_volume, "lut_ext"))
        .when(by_pattern & (volume >= promote_min_volume), "lut")
    )
    last = F.max(F.struct((-volume).alias("v"), "keyword_norm", "oracle_genre", "_lut", "_ext"))
    return (
        rows.withColumn("target", target)
        .where(F.col("target").isNotNull())
        .groupBy("target", F.col("kw").alias("keyword"))
        .agg(last.alias("l"))
        .select(
            "target",
            "keyword",
            F.coalesce("l._lut", "l._ext", F.lit("regex")).alias("old_genre"),
            F.col("l.oracle_genre").alias("new_genre"),
            (-F.col("l.v")).alias("search_count"),
        )
    )


def apply_lookup_fixes(lookup: DataFrame, fixes: DataFrame, direct: DataFrame | None = None) -> DataFrame:
    """(keyword, genre, changed): ``direct`` corrections first, then ``fixes``, which win."""
    new = fixes.select("keyword", F.col("new_genre").alias("_fix"))
    out = lookup.select("keyword", F.col("genre").alias("_old"))
    if direct is not None:
        out = out.join(direct.select("keyword", F.col("genre").alias("_direct")), "keyword", "full_outer")
    else:
        out = out.withColumn("_direct", F.lit(None).cast("string"))
    out = out.join(new, "keyword", "full_outer")
    genre = F.coalesce("_fix", "_direct", "_old")
    return out.select("keyword", genre.alias("genre"), (~genre.eqNullSafe(F.col("_old"))).alias("changed"))


def fix_summary(plan: DataFrame) -> DataFrame:
    """Planned changes by target and pair of genres."""
    return plan.where(F.col("old_genre") != F.col("new_genre")).groupBy("target", "old_genre", "new_genre").agg(
        F.count("*").alias("entries")
    )
