"""Distributed positions and average ranks inside groups, skew-proof.

``row_number()`` / ``rank()`` over ``Window.partitionBy(g)`` puts a whole group
in one task; over no partition, the whole table.  Here instead:

1. ``repartitionByRange(n, *group, value, *tiebreak)``: Spark samples the key
   distribution, so a hot group is split over many partitions in key order;
2. ``sortWithinPartitions`` and ``monotonically_increasing_id`` give each row
   its partition id and index inside the partition;
3. the result is checkpointed (reliable, in ``spark.checkpoint.dir``) so every
   later job sees the very same partitioning;
4. a tiny table of (partition, group) -> count, min index is turned into
   per-group starting offsets with a window over partitions (one row per
   partition and group) and joined back by broadcast; its size is bounded by
   partitions x groups-per-partition and checked before broadcasting.

Ranks and quantiles with ties work on distinct values: ``running_counts`` counts
each (group, value) with a map-side combine and runs the same offsets over those
counts, so a value that a third of the rows share is one row.  Group keys may be
NULL: every join on them is NULL-safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOW33 = (1 << 33) - 1
BROADCAST_ROWS = 2_000_000
BROADCAST_RANKS = 100_000


def _maybe_broadcast(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def null_safe(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join on columns of the same names, NULL equal to NULL; ``left``'s keys are kept."""
    on = list(on)
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c)
                             for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(renamed[f"__r_{c}"])
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in on])


def positions(df: DataFrame, group_cols, order_cols, out: str = "pos",
              num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its group, ordered by ``order_cols``.

    Order columns should make the order total (append a unique key) when the
    positions must be reproducible row by row.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = group_cols + order_cols
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    ranged = cut_lineage(ranged)
    g = group_cols or []
    counts = ranged.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_c"),
                                            F.min("_loc").alias("_first"))
    w = Window.partitionBy(*g).orderBy("_pid") if g else Window.orderBy("_pid")
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    offs = cut_lineage(offs.select("_pid", *g, "_off", "_first"))
    rows = offs.count()
    joined = null_safe(ranged, _maybe_broadcast(offs, rows), ["_pid", *g])
    return joined.withColumn(out, F.col("_off") + F.col("_loc") - F.col("_first") + 1).drop(
        "_mid", "_pid", "_loc", "_off", "_first")


def running_counts(df: DataFrame, group_cols, value_col: str,
                   num_partitions: int | None = None) -> DataFrame:
    """Per (group, value): ``_count`` rows, and ``_before`` rows of smaller values in the group."""
    group_cols = list(group_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, value_col]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"))
    ranged = cut_lineage(counts.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()))
    total = ranged.groupBy("_pid", *group_cols).agg(F.sum("_count").alias("_t"))
    earlier = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offs = cut_lineage(total.select("_pid", *group_cols, F.coalesce(
        F.sum("_t").over(earlier), F.lit(0)).alias("_off")))
    own = Window.partitionBy("_pid", *group_cols).orderBy(value_col).rowsBetween(
        Window.unboundedPreceding, -1)
    local = ranged.withColumn("_own", F.coalesce(F.sum("_count").over(own), F.lit(0)))
    return (null_safe(local, _maybe_broadcast(offs, offs.count()), ["_pid", *group_cols])
            .withColumn("_before", F.col("_off") + F.col("_own")).drop("_pid", "_off", "_own"))


def average_ranks(df: DataFrame, group_cols, value_col: str, out: str = "rank",
                  num_partitions: int | None = None) -> DataFrame:
    """Average (mid) rank of ``value_col`` within each group; ties share their mean rank.

    NULL values get a NULL rank and do not count; a NULL group is a group.
    """
    group_cols = list(group_cols)
    base = df.filter(F.col(value_col).isNotNull()).select(*group_cols, value_col)
    avg = cut_lineage(running_counts(base, group_cols, value_col, num_partitions).select(
        *group_cols, value_col, (F.col("_before") + (F.col("_count") + 1) / 2.0).alias(out)))
    few = avg.count() <= BROADCAST_RANKS
    return null_safe(df, F.broadcast(avg) if few else avg, [*group_cols, value_col], "left")


def tie_counts(df: DataFrame, group_cols, value_col: str) -> DataFrame:
    """Per group: sum over tie blocks of (t^3 - t), the tie-correction term."""
    t = df.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_t"))
    return t.groupBy(*group_cols).agg(
        F.sum(F.pow(F.col("_t"), 3) - F.col("_t")).alias("tie_term"))


def running_totals(df: DataFrame, order_col: str, value_cols, descending: bool = True,
                   num_partitions: int | None = None) -> DataFrame:
    """Cumulative sums of ``value_cols`` in ``order_col`` order over the whole table.

    Rows must be unique in ``order_col`` (aggregate ties first).  Range
    partitioning + per-partition totals + broadcast offsets, as in ``positions``;
    the offsets table has one row per partition.
    """
    value_cols = list(value_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = (df.repartitionByRange(n, key).sortWithinPartitions(key)
                .withColumn("_pid", F.spark_partition_id()))
    ranged = cut_lineage(ranged)
    tot = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(w), F.lit(0)).alias(f"_o_{c}")
                                for c in value_cols])
    offs = cut_lineage(offs)
    within = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(within).alias(f"_l_{c}") for c in value_cols])
    out = local.join(F.broadcast(offs), "_pid")
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"cum_{c}")
                                     for c in value_cols])
