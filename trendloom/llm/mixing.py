"""Mix sources to target word counts by entropy balancing.

Sources weigh 3, 1, 2, 3, 1, 2, ... in order of their names and share ``SHARE`` of all words by weight; none may exceed
``CAP`` times its own words, and what it cannot take is shared among the others.

Each document gets a rate between 0 and CAP, the expected number of its copies. Among all rates that bring a
source to its target, those closest to the rate of one copy each, in relative entropy (of a choice among the CAP
possible copies), are exponentially tilted: rate = CAP / (1 + exp(-tilt * size / mean size)), with one tilt per source. The
tilts solve the convex dual, by Newton steps that all sources take at once; each step is one aggregation. As rates
depend on source and size alone, the steps read the counts of (source, size), not the documents.

Rates are rounded into copies. Sizes of a source are taken from large to small, and every size gets the number of
copies that brings the words so far closest to their share; so a source ends within about half its smallest
document of the target. Which documents of a size get the extra copy is settled by a hash of their ids. Documents
of one size are dealt into parts of about ``PART_ROWS`` for that, so a size that very many share is not one group.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import ship_package, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
TOLERANCE = 1e-6
MAX_STEPS = 100
PART_ROWS = 4096


def word_count(text: Column) -> Column:
    """Number of runs of anything but space and U+0009 to U+000D; 0 for null."""
    trimmed = F.btrim(text, F.lit(common.SPACES))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(totals: DataFrame) -> DataFrame:
    """(source, source_size) with the target of each. One row per source goes through a window of its own.

    With shares level * weight, the sources with the smallest room (CAP * size) for their weight fill up first, one
    after the other; the level of the rest follows from what is left.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = totals.withColumn("weight", F.array(*[F.lit(float(w)) for w in WEIGHTS])[F.pmod(place, F.lit(len(WEIGHTS)))])
    room = weighted.withColumn("room", F.col("source_size") * float(CAP))
    order = Window.orderBy(F.col("room") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * SHARE - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = room.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") > F.col("room"))
    rest = F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), "source", "level"))).over(every)["level"]
    target = F.when(F.col("full") | (rest * F.col("weight") > F.col("room")), F.col("room")).otherwise(rest * F.col("weight"))
    return filled.select("source", "source_size", target.alias("target"))


def _exact_sum(value: Column, n: Column) -> Column:
    """Sum of n times a value kept to six places, the same whatever the order of the rows."""
    return F.sum(value.cast("decimal(24,6)") * n.cast("decimal(14,0)")).cast("double")


def rate(tilt: Column, size: Column, mean: Column) -> Column:
    return CAP / (1 + F.exp(F.least(F.greatest(-tilt * size / mean, F.lit(-700.0)), F.lit(700.0))))


def solve(counts: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with the tilt of each source: the root of words(tilt) = target, one aggregation for each Newton step.

    A step that leaves the bracket known to hold the root is replaced by halving it. A source that takes all it
    may, or nothing, has no finite root and gets an infinite tilt.
    """
    spark = counts.sparkSession
    mean = counts.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    whole = F.col("target") >= CAP * F.col("source_size") * (1 - TOLERANCE)
    state = goals.join(mean, goals["source"].eqNullSafe(mean["source"])).select(
        goals["source"], "source_size", "target", "mean",
        F.when(whole, F.lit(math.inf)).when(F.col("target") <= 0, F.lit(-math.inf)).otherwise(0.0).alias("tilt"),
        F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high"), F.lit(False).alias("done"),
    )
    state = stage(state, "tilts")
    for _ in range(MAX_STEPS):
        active = state.where(~F.col("done") & ~F.col("tilt").isin(math.inf, -math.inf))
        if active.isEmpty():
            break
        one = counts.alias("c").join(active.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        r, n = rate(F.col("tilt"), F.col("size"), F.col("mean")), F.col("n")
        words, slope = r * F.col("size"), r * (1 - r / CAP) * F.col("size") * F.col("size") / F.col("mean")
        sums = one.groupBy(F.col("s.source").alias("of")).agg(_exact_sum(words, n).alias("words"), _exact_sum(slope, n).alias("slope"))
        gap = F.col("target") - F.col("words")
        low = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + F.try_divide(gap, F.col("slope"))
        below, above = F.col("low2"), F.col("high2")
        half = (
            F.when(below == -math.inf, above - 2 - F.abs(above))
            .when(above == math.inf, below + 2 + F.abs(below))
            .otherwise((below + above) / 2)
        )
        bounded = (F.col("newton") > below) & (F.col("newton") < above) & (F.abs(F.col("newton") - F.col("tilt")) < 8)
        after = (
            state.alias("s").join(sums, F.col("s.source").eqNullSafe(F.col("of")), "left")
            .withColumn("low2", F.coalesce(low, "low")).withColumn("high2", F.coalesce(high, "high")).withColumn("newton", newton)
            .withColumn("met", F.col("words").isNull() | (F.abs(gap) <= F.col("target") * TOLERANCE))
            .withColumn("next", F.when(F.col("met"), F.col("tilt")).when(bounded, F.col("newton")).otherwise(half))
        )
        old = common.folder_of(state)
        state = stage(after.select("s.source", "source_size", "target", "mean", F.col("next").alias("tilt"), F.col("low2").alias("low"), F.col("high2").alias("high"), F.col("met").alias("done")), "tilts")
        common.discard(spark, old)
    return state.select("source", "source_size", "target", "mean", "tilt")


def _round_sizes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Copies of each size of a source, from large to small; what rounding adds or leaves is made up for by the next."""
    pdf = pdf.sort_values("size", ascending=False, ignore_index=True)
    copies, taken, due = [], 0, 0.0
    for size, n, wanted in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist()):
        due += wanted * n * size
        k = min(max(math.floor((due - taken) / size + 0.5), 0), CAP * n)
        copies.append(k)
        taken += k * size
    return pdf.assign(copies=copies)[["source_no", "size", "copies"]]


def mix(docs: DataFrame, key: list[str]) -> DataFrame:
    """docs (any columns, with source, size and the key) with source_size, target and copies.

    Rows that agree in their whole key may get different copies; how many such rows get how many is settled.
    """
    ship_package(docs.sparkSession)
    counts = stage(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    solved = stage(solve(counts, targets(totals)).withColumn("source_no", F.xxhash64("source", F.col("source").isNull())), "solved")
    sized = counts.alias("c").where("size > 0").join(solved.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
    tilted = rate(F.col("tilt"), F.col("size"), F.col("mean"))
    sized = sized.select("c.source", "source_no", "size", "n", tilted.alias("rate"))
    rounded = sized.groupBy("source_no").applyInPandas(_round_sizes, "source_no long, size long, copies long")
    plan = stage(sized.join(rounded, ["source_no", "size"]).select("source", "size", "n", "copies"), "copies")

    rows = docs.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size")), "left")
    part = F.pmod(F.xxhash64(*[F.col(f"d.{k}") for k in key], F.lit(1)), F.ceil(F.col("n") / PART_ROWS))
    rows = rows.select("d.*", "n", F.coalesce("copies", F.lit(0)).alias("all_copies"), F.coalesce(part, F.lit(0)).alias("part"))
    # Split the copies of a size over its parts by running shares.
    parts = rows.where("all_copies > 0").groupBy("source", "size", "part").agg(F.count("*").alias("m"), F.first("n").alias("n"), F.first("all_copies").alias("all_copies"))
    upto = F.sum("m").over(Window.partitionBy("source", "size").orderBy("part"))
    share = lambda c: F.floor(F.col("all_copies") * c / F.col("n"))
    parts = parts.withColumn("upto", upto).select("source", "size", "part", "m", (share(F.col("upto")) - share(F.col("upto") - F.col("m"))).alias("k"))
    joined = rows.alias("r").join(
        parts.alias("q"), F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r.size") == F.col("q.size")) & (F.col("r.part") == F.col("q.part")), "left"
    )
    first = F.row_number().over(Window.partitionBy("r.source", "r.size", "r.part").orderBy(F.xxhash64(*[F.col(f"r.{k}") for k in key]), *[F.col(f"r.{k}") for k in key]))
    copies = F.coalesce(F.floor(F.col("k") / F.col("m")) + (first <= F.pmod("k", "m")).cast("long"), F.lit(0))
    chosen = joined.select("r.*", copies.alias("copies")).drop("n", "all_copies", "part")
    return chosen.alias("c").join(solved.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.*", "source_size", "target")


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row: the words that the mix takes of it, repeats counted.

    Null texts and texts without a word have size 0 and are not taken. Null sources are a source of their own, the
    last. Null ids and repeated rows are kept, each row by itself. An empty table gives no rows. Further
    columns are ignored. Reruns agree.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"))
    mixed = mix(stage(rows, "sizes-of-documents"), ["doc_id", "text_key"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, with all their columns and size, source_size, target, copies and taken.

    Rows that agree in id, text and source are one row whose copies are added up. A column of docs that has one of
    these five names gives way.
    """
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    id_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id_key")
    text_key = F.xxhash64(text, F.col("doc_id").isNull(), source, source.isNull()).alias("text_key")
    sizes = stage(docs.select(id_key, text_key, source.alias("source"), word_count(text).alias("size")), "sizes-of-documents")
    added = ("size", "source_size", "target", "copies", "taken")
    mixed = mix(sizes, ["id_key", "text_key"]).groupBy("id_key", "text_key").agg(
        F.max("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("copies").alias("copies")
    )
    mixed = mixed.where("copies > 0").withColumn("taken", F.col("copies") * F.col("size"))
    rows = docs.select(id_key, text_key, F.struct(*[c for c in docs.columns if c.lower() not in added]).alias("row"))
    once = rows.join(mixed, ["id_key", "text_key"]).dropDuplicates(["id_key", "text_key"])
    return once.select("row.*", *added)
