"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import common
from trendloom.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (u, v); root is the smallest node of its component.

    Alternates the two star operations until the edges no longer change. Each round writes its edges to
    the shared folder. Minima are taken before the shuffle; no neighbourhood is ever gathered.
    """
    spark = edges.sparkSession
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = stage(ordered, "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = mark
        old, edges = common.folder_of(edges), stage(_small_star(_large_star(edges)), "edges")
        common.discard(spark, old)
