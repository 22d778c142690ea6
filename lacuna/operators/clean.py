"""Cleaning and projection operators (B1-B14) and input contracts (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import finite_or_null, risk_class, to_date_or_null, to_double, truthy
from .quantile import exact_quantiles


class ContractError(ValueError):
    pass


def deduplicate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B1: drop full-row duplicates (NULLs compare equal).

    Returns (deduplicated frame, one-row frame rows_before / rows_after / removed).
    The counts are two aggregates over the same input, computed lazily.
    """
    out = df.dropDuplicates()
    before = df.agg(F.count(F.lit(1)).alias("rows_before"))
    after = out.agg(F.count(F.lit(1)).alias("rows_after"))
    stats = before.crossJoin(after).select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("removed"))
    return out, stats


def coerce_types(df: DataFrame, date_cols=(), numeric_cols=(), categorical_cols=(),
                 date_format: str | None = None) -> DataFrame:
    """Invalid dates and non-numeric text become NULL; categoricals become text."""
    d, n, c = set(date_cols), set(numeric_cols), set(categorical_cols)
    sel = []
    for x in df.columns:
        if x in d:
            sel.append(to_date_or_null(x, date_format).alias(x))
        elif x in n:
            sel.append(to_double(x).alias(x))
        elif x in c:
            sel.append(F.col(x).cast("string").alias(x))
        else:
            sel.append(F.col(x))
    return df.select(*sel)


def check_contract(df: DataFrame, required=(), date_cols=(), allow_empty: bool = False) -> dict:
    """A4: one aggregation pass counting violations; raises on any.

    Checks: non-empty input, required columns present, no NULL (invalid) date.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"Required column(s) missing: {missing}")
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"invalid_{c}") for c in date_cols]
    r = df.agg(*aggs).first().asDict()
    if not allow_empty and r["rows"] == 0:
        raise ContractError("The input dataframe is empty.")
    for c in date_cols:
        if r[f"invalid_{c}"]:
            raise ContractError(f"{r[f'invalid_{c}']} invalid date values were found in {c}.")
    return r


def violation_counts(df: DataFrame, date_cols=(), numeric_cols=()) -> DataFrame:
    """A4 as data: rows, NULL/invalid dates and non-coercible numerics per column."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in date_cols:
        aggs.append(F.count_if(F.col(c).isNotNull() & to_date_or_null(c).isNull())
                    .alias(f"invalid_{c}"))
    for c in numeric_cols:
        aggs.append(F.count_if(F.col(c).isNotNull() & to_double(c).isNull())
                    .alias(f"non_numeric_{c}"))
    return df.agg(*aggs)


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    """Rows with a NULL in any of ``cols`` are dropped."""
    return df.dropna(subset=list(cols))


def with_risk_class(df: DataFrame, rate_col: str, out: str = "Occupancy_Class",
                    high: float = 85.0, moderate: float = 70.0) -> DataFrame:
    """High / Moderate / Low (NULL falls to Low)."""
    return df.withColumn(out, risk_class(rate_col, high, moderate))


def with_truthy(df: DataFrame, col: str, out: str) -> DataFrame:
    """Flag normaliser by the column's Spark type."""
    t = dict(df.dtypes)[col]
    kind = "boolean" if t == "boolean" else (
        "numeric" if t in ("int", "bigint", "double", "float", "smallint", "tinyint")
        or t.startswith("decimal") else "string")
    return df.withColumn(out, truthy(col, kind))


def first_available(df: DataFrame, candidates) -> str | None:
    """First candidate column name present in the schema."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def min_max_normalize(df: DataFrame, cols, suffix: str = "_Normalized") -> DataFrame:
    """(x - min) / (max - min); constant or all-NULL column -> 0.0 everywhere.

    min/max come from one aggregation pass (partial aggregation, one row) and
    are inlined as literals; no join.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    vals = df.agg(*[F.min(to_double(c)).alias(f"mn{i}") for i, c in enumerate(cols)],
                  *[F.max(to_double(c)).alias(f"mx{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        mn, mx = vals[f"mn{i}"], vals[f"mx{i}"]
        if mn is None or mx is None or mx == mn:
            expr = F.lit(0.0)
        else:
            expr = (to_double(c) - F.lit(mn)) / F.lit(mx - mn)
        out = out.withColumn(f"{c}{suffix}", expr)
    return out


def robust_scale_params(df: DataFrame, cols) -> dict:
    """B14 fit: exact median and IQR per column (IQR 0 -> 1)."""
    q = exact_quantiles(df.select(*[to_double(c).alias(c) for c in cols]), cols,
                        [0.25, 0.5, 0.75])
    out = {}
    for c in cols:
        med, q1, q3 = q[(c, 0.5)], q[(c, 0.25)], q[(c, 0.75)]
        iqr = (q3 - q1) if q1 is not None else None
        out[c] = (med, iqr if iqr else 1.0)
    return out


def robust_scale(df: DataFrame, cols, params: dict | None = None,
                 suffix: str = "_Scaled") -> DataFrame:
    """B14 transform: (x - median) / IQR."""
    params = params or robust_scale_params(df, cols)
    out = df
    for c in cols:
        med, iqr = params[c]
        expr = (to_double(c) - F.lit(med)) / F.lit(iqr) if med is not None else F.lit(None)
        out = out.withColumn(f"{c}{suffix}", expr.cast("double"))
    return out


def nonfinite_to_null(df: DataFrame, cols) -> DataFrame:
    """B6."""
    s = set(cols)
    return df.select(*[finite_or_null(F.col(c)).alias(c) if c in s else F.col(c)
                       for c in df.columns])


def preview(df: DataFrame, order_cols, n_rows: int = 80, n_cols: int = 12,
            width: int = 28) -> DataFrame:
    """A5: first ``n_rows`` rows by key, first ``n_cols`` columns, text cut to ``width``.

    ``orderBy(...).limit(n)`` plans as a top-k (TakeOrderedAndProject): each task
    keeps n rows, no full sort.
    """
    cols = df.columns[:n_cols]
    top = df.orderBy(*order_cols).limit(n_rows)
    return top.select(*[F.substring(F.col(c).cast("string"), 1, width).alias(c) for c in cols])
