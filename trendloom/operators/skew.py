"""Joins, ranks and row numbers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more than this part of one shuffle partition's fair share of the rows is split.
SHARE_OF_PARTITION = 0.25


def salted_left_join(
    facts: DataFrame, dim: DataFrame, key: str, spread_by: Column, dim_rows: str, min_rows: int | None = None
) -> DataFrame:
    """``facts LEFT JOIN dim USING (key)`` where ``dim`` has one row per key and is cheap to read twice.

    ``dim_rows`` names the column of ``dim`` with each key's number of fact rows. A key with ``min_rows`` rows or
    more is hot: its rows go to one place for every ``min_rows`` of them, and its row in ``dim`` is copied to each.
    By default ``min_rows`` is a quarter of the rows that a shuffle partition would get if all were alike, so at
    most four keys per partition are hot; that bounds the frame of hot keys. Null keys never match and are
    spread as widely as all rows together.
    """
    total = dim.agg(F.coalesce(F.sum(dim_rows), F.lit(0))).first()[0]
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if min_rows is None:
        min_rows = max(1, int(total * SHARE_OF_PARTITION / partitions))
    marked = dim.withColumn("_places", F.greatest(F.ceil(F.col(dim_rows) / min_rows), F.lit(1)).cast("int"))
    hot = marked.where("_places > 1").select(F.col(key).alias("_hot"), F.col("_places").alias("_spread"))
    right = marked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_places") - 1))).drop("_places")
    spread = F.when(F.col(key).isNull(), F.lit(int(partitions / SHARE_OF_PARTITION))).otherwise(F.coalesce("_spread", F.lit(1)))
    left = (
        facts.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), spread).cast("int"))
        .drop("_hot", "_spread")
    )
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def rank_desc(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    name: str,
    limit: int | None = None,
) -> DataFrame:
    """SQL ``RANK() OVER (PARTITION BY groups ORDER BY value DESC)``, rows in parallel.

    A window would pull each group into one task, and there are few groups. The rank of a row
    only depends on how many rows of its group have a larger value, so it is read off a
    histogram of the values: one window over (group, value) pairs, then a join back. With
    ``limit`` only ranks up to it are kept, ties included; the histogram then has at most
    ``limit`` entries per group. ``df`` is read twice and should be cheap to read.
    """
    hist = df.groupBy(*groups, value).agg(F.count("*").alias("_n"))
    above = Window.partitionBy(*groups).orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.withColumn(name, F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1)
    if limit is not None:
        ranks = ranks.where(F.col(name) <= limit)
    keys = [*groups, value]
    right = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in keys], name)
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    return df.join(right, on, "inner").drop(*[f"_r_{c}" for c in keys])


def row_number_in_slices(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], slice_of: Column, name: str
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY groups ORDER BY order)`` without one task per group.

    ``slice_of`` must grow with ``order``. Rows are numbered within each slice; the rows of the
    earlier slices, counted beforehand, are added on top.
    """
    sliced = df.withColumn("_slice", slice_of)
    keys = [*groups, "_slice"]
    sizes = sliced.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_o_{c}") for c in keys],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in keys])
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        sliced.withColumn("_within", within)
        .join(offsets, on, "inner")
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_slice", "_within", "_before", *[f"_o_{c}" for c in keys])
    )
