"""Masked panels the registered queries repair (Spark side of ``fixtures_sql``)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.missing import mask_column
from ..sources.tables import events_series, order_facts

MASK_RATE = 0.12


def masked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.value with 12 % of cells masked (MCAR); ``was_masked`` marks them."""
    ev = events_series(spark, sf_dir).withColumn("true_value", F.col("value"))
    out, _ = mask_column(ev, ["event_id"], "value", MASK_RATE, flag="was_masked")
    return out.persist(StorageLevel.MEMORY_AND_DISK)   # read by several passes


def masked_order_facts(spark: SparkSession, sf_dir: str,
                       cols=("extprice", "qty", "o_totalprice")) -> DataFrame:
    """order_facts with each listed column masked independently at 12 %."""
    df = order_facts(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    for c in cols:
        df, _ = mask_column(df, ["o_orderkey"], c, MASK_RATE)
    return df.persist(StorageLevel.MEMORY_AND_DISK)   # read by several passes
