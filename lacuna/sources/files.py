"""File sources and sinks (A1-A3): CSV scan with contract, table and JSON sinks.

Paths are caller-given (on a cluster: a shared file system / object store).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from ..operators.clean import ContractError, check_contract
from ..functions.exprs import to_date_or_null


def load_panel_csv(spark: SparkSession, path: str, date_col: str = "Date", schema=None,
                   date_format: str | None = None) -> DataFrame:
    """A1: CSV with header; the date column parsed (invalid -> NULL) and checked.

    Raises ``ContractError`` when the date column is absent, the file is empty or
    any date is invalid (one aggregation pass counts the violations).
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    df = reader.csv(path)
    if date_col not in df.columns:
        raise ContractError(f"{path}: no date column {date_col!r} among {df.columns}")
    df = df.withColumn(date_col, to_date_or_null(date_col, date_format))
    check_contract(df, required=[date_col], date_cols=[date_col])
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    """A2: table sink (parquet by default, CSV with header on request)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def summary_frame(spark: SparkSession, payload: dict) -> DataFrame:
    """A3: a run summary (nested dict) as a one-row DataFrame with a JSON column."""
    return spark.createDataFrame([(json.dumps(payload, default=str, sort_keys=True),)],
                                 "summary string")


def write_summary(spark: SparkSession, payload: dict, path: str) -> None:
    """A3: one JSON document, written by Spark (single small row)."""
    summary_frame(spark, payload).coalesce(1).write.mode("overwrite").text(path)
