"""Comparing the classifier's genres with those of an independent labeller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.schemas import GENRES, UNKNOWN


def eval_keywords(gold: DataFrame, include_unknown: bool = False, min_len: int = 2) -> DataFrame:
    """(keyword_norm, rules_genre, search_count): each keyword with its genre of largest volume.

    Ties go to the first genre in alphabetical order.
    """
    rows = gold.where(F.length("keyword_norm") >= min_len)
    if not include_unknown:
        rows = rows.where(F.col("derived_genre") != UNKNOWN)
    volume = rows.groupBy("keyword_norm", "derived_genre").agg(F.sum("search_count").alias("search_count"))
    first = F.min(F.struct((-F.col("search_count")).alias("_v"), "derived_genre"))
    return (
        volume.groupBy("keyword_norm")
        .agg(first.alias("b"))
        .select("keyword_norm", F.col("b.derived_genre").alias("rules_genre"), (-F.col("b._v")).alias("search_count"))
    )


def eval_compare(keywords: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the labeller's genre, UNKNOWN where it gave none, and whether both agree."""
    theirs = labels.select("keyword_norm", F.col("genre").alias("oracle_genre"))
    return (
        keywords.join(theirs, "keyword_norm", "left")
        .withColumn("oracle_genre", F.coalesce("oracle_genre", F.lit(UNKNOWN)))
        .withColumn("agree", F.col("rules_genre") == F.col("oracle_genre"))
        .select("keyword_norm", "rules_genre", "oracle_genre", "agree", "search_count")
    )


def _genre_grid(spark: SparkSession) -> DataFrame:
    domain = F.array(*[F.lit(g) for g in GENRES])
    one = spark.range(1).select(F.explode(domain).alias("rules_genre"))
    return one.withColumn("oracle_genre", F.explode(domain))


def confusion_matrix(compared: DataFrame) -> DataFrame:
    """Keywords and volume for all pairs of genres, zero where none occurred."""
    keys = ["rules_genre", "oracle_genre"]
    cells = compared.groupBy(*keys).agg(F.count("*").alias("keywords"), F.sum("search_count").alias("volume"))
    return _genre_grid(compared.sparkSession).join(cells, keys, "left").fillna(0, ["keywords", "volume"])


def genre_outcomes(compared: DataFrame) -> DataFrame:
    """tp, fp and fn per genre, by keywords and by volume, the labeller being right.

    A disagreement is a false positive of one genre and a false negative of the other. All
    contributions are emitted by one explode and summed before the shuffle.
    """
    outcome = F.when(
        F.col("agree"), F.array(F.struct(F.col("rules_genre").alias("genre"), F.lit("tp").alias("kind")))
    ).otherwise(
        F.array(
            F.struct(F.col("rules_genre").alias("genre"), F.lit("fp").alias("kind")),
            F.struct(F.col("oracle_genre").alias("genre"), F.lit("fn").alias("kind")),
        )
    )
    each = compared.select("search_count", F.explode(outcome).alias("o")).select("search_count", "o.genre", "o.kind")
    sums = {k: F.count_if(F.col("kind") == k).alias(k) for k in ("tp", "fp", "fn")}
    volumes = {
        k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("search_count"))), F.lit(0)).alias(f"{k}_volume")
        for k in ("tp", "fp", "fn")
    }
    domain = compared.sparkSession.range(1).select(F.explode(F.array(*[F.lit(g) for g in GENRES])).alias("genre"))
    counted = each.groupBy("genre").agg(*sums.values(), *volumes.values())
    return domain.join(counted, "genre", "left").fillna(0)


def genre_prf(compared: DataFrame) -> DataFrame:
    """Precision, recall and F1 per genre by keywords and by volume; 0 on empty denominators."""

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    out = genre_outcomes(compared).withColumn("support", F.col("tp") + F.col("fn"))
    for suffix in ("", "_volume"):
        tp, fp, fn = (F.col(k + suffix) for k in ("tp", "fp", "fn"))
        out = out.withColumns({f"precision{suffix}": ratio(tp, tp + fp), f"recall{suffix}": ratio(tp, tp + fn)})
        p, r = F.col(f"precision{suffix}"), F.col(f"recall{suffix}")
        out = out.withColumn(f"f1{suffix}", ratio(2 * p * r, p + r))
    return out


def macro_scores(prf: DataFrame) -> DataFrame:
    """Plain means over the genres. The mean volume precision is given under its own name."""
    return prf.agg(
        F.avg("f1").alias("macro_f1"),
        F.avg("f1_volume").alias("macro_f1_volume"),
        F.avg("precision_volume").alias("macro_precision_volume"),
    )


def eval_accuracy(compared: DataFrame) -> DataFrame:
    n, volume = F.count("*"), F.sum("search_count")
    right = F.coalesce(F.sum(F.when(F.col("agree"), F.col("search_count"))), F.lit(0))
    return compared.agg(
        n.alias("keywords"),
        volume.alias("volume"),
        F.count_if("agree").alias("agree_keywords"),
        right.alias("agree_volume"),
        (F.count_if("agree") / F.nullif(n, F.lit(0))).alias("count_accuracy"),
        (right / F.nullif(volume, F.lit(0))).alias("volume_accuracy"),
    )


def top_misclassified(compared: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` disagreements of largest volume, and one row (null keyword) for the others' number and volume.

    The others are all disagreements less the listed ones, so nothing has to be numbered.
    """
    wrong = compared.where(~F.col("agree"))
    top = (
        wrong.orderBy(F.desc("search_count"), "keyword_norm")
        .limit(n)
        .select("keyword_norm", "rules_genre", "oracle_genre", F.lit(1).cast("bigint").alias("keywords"), "search_count")
    )
    signed = wrong.select(F.lit(1).alias("sign"), "search_count").unionAll(top.select(F.lit(-1), "search_count"))
    rest = signed.agg(
        F.lit(None).cast("string").alias("keyword_norm"),
        F.lit(None).cast("string").alias("rules_genre"),
        F.lit(None).cast("string").alias("oracle_genre"),
        F.coalesce(F.sum("sign"), F.lit(0)).cast("bigint").alias("keywords"),
        F.coalesce(F.sum(F.col("sign") * F.col("search_count")), F.lit(0)).alias("search_count"),
    )
    return top.unionByName(rest)


def build_test_cases(compared: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """Expected genre per keyword: the agreed one, or the adjudicated one if valid, or the classifier's."""
    ruling = adjudicated.select("keyword_norm", F.col("genre").alias("_ruling"))
    valid = F.when(F.col("_ruling").isin(*GENRES), F.col("_ruling"))
    agree = F.col("agree")
    return (
        compared.join(ruling, "keyword_norm", "left")
        .select(
            "keyword_norm",
            F.when(agree, F.col("rules_genre")).otherwise(F.coalesce(valid, "rules_genre")).alias("expected_genre"),
            "search_count",
            F.when(agree, "high").otherwise("adjudicated").alias("confidence"),
            F.when(agree, "agree").otherwise("adjudicator").alias("source"),
        )
        .orderBy(F.desc("search_count"), "keyword_norm")
    )


def test_set_summary(cases: DataFrame) -> DataFrame:
    return cases.groupBy("expected_genre", "confidence").agg(
        F.count("*").alias("keywords"), F.sum("search_count").alias("volume")
    )
