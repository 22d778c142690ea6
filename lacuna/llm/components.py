"""Connected components by alternating stars, over edges that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node that has an edge to another.

    The component is the smallest node of it.  Large star: each node links its
    larger neighbours to its smallest one; small star: its smaller neighbours.
    Minima are partial sums per task, and a hub's edges meet one row of its
    minimum, so Spark can split that join.  Rounds grow as the logarithm of a
    component's size; each ends in a checkpoint.
    """
    now = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .where("u <> v").distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct())
        seen = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut_lineage(small.union(least.select("u", "m")).distinct())


def ids_of_several(rows: DataFrame, key: str, *content: str) -> DataFrame:
    """Ids of rows that differ in ``content``; checkpointed, column ``key``."""
    mark = F.xxhash64(*content)
    return cut_lineage(rows.where(F.col(key).isNotNull()).groupBy(key)
                       .agg(F.min(mark).alias("lo"), F.max(mark).alias("hi"))
                       .where("lo <> hi").select(key))
