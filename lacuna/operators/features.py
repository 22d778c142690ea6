"""Feature engineering (G1-G16): row arithmetic, calendar parts, lagged series.

Row features are plain column expressions (whole-stage codegen, no shuffle).
Series features share one window specification per panel: one shuffle on the
group keys and one sort; rolling frames are bounded (7 / 14 rows).  The warm-up
fill uses a grouped exact median joined back on the group key and a global
median from ``quantile.exact_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col as _c, season_of
from ..spec import PanelSpec
from .quantile import exact_quantiles


def row_total(cols, floor: float = 1.0) -> Column:
    """G1: NULL-skipping row sum, floored (a row of NULLs sums to 0, then the floor)."""
    s = None
    for c in cols:
        t = F.coalesce(_c(c).cast("double"), F.lit(0.0))
        s = t if s is None else s + t
    return F.greatest(s, F.lit(float(floor)))


def ratio(num, den) -> Column:
    """x / y with the divisor already floored; NULL numerators stay NULL."""
    return _c(num).cast("double") / _c(den)


def pressure(num, den, floor: float = 1.0) -> Column:
    """Num / max(den, floor)."""
    return _c(num).cast("double") / F.greatest(_c(den).cast("double"), F.lit(float(floor)))


def square(c) -> Column:
    x = _c(c).cast("double")
    return x * x


def calendar_features(df: DataFrame, date_col: str, holiday_col: str | None = None,
                      prefix: str = "") -> DataFrame:
    """Month, quarter, weekday (Mon=0), weekend, holiday flag, season."""
    d = F.to_date(F.col(date_col))
    out = df.withColumn(f"{prefix}Month", F.month(d)) \
            .withColumn(f"{prefix}Quarter", F.quarter(d)) \
            .withColumn(f"{prefix}Day_of_Week", F.weekday(d)) \
            .withColumn(f"{prefix}Weekend_Indicator",
                        F.col(f"{prefix}Day_of_Week").isin(5, 6).cast("int")) \
            .withColumn(f"{prefix}Season", season_of(F.month(d)))
    if holiday_col:
        out = out.withColumn(f"{prefix}Holiday_Indicator",
                             F.coalesce(F.col(holiday_col) == F.lit("Yes"), F.lit(False)).cast("int"))
    return out


TEMPORAL_SUFFIXES = ["Lag_1", "Growth", "Rolling_Mean_7", "Rolling_Median_7",
                     "Moving_Average_14"]


def temporal_features(df: DataFrame, spec: PanelSpec, col: str, warmup_fill: bool = True,
                      name: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """G11-G16 for one column, within each series of ``spec``.

    lag 1; growth = pct change after forward fill (+/-inf -> NULL); rolling mean /
    median over the previous 7 rows (>= 2 known); moving average over the previous
    14 rows (>= 3 known); then warm-up gaps -> group median -> global median.
    """
    from .series import carry_last, choose_carry, with_halo
    name = name or col
    x = F.col(col).cast("double")
    hot = choose_carry(df, spec, hot_rows)
    if hot:
        # a hot series: carried forward fill, then windows over slices with a
        # 14-row halo of the preceding rows of the same series
        base = carry_last(df, spec, {"_ff": x})
        src = with_halo(base, spec, 14)
        w = Window.partitionBy("_slice", *spec.group_keys).orderBy(*spec.ordering)
    else:
        w = Window.partitionBy(*spec.group_keys).orderBy(*spec.ordering)
        src = df.withColumn("_ff", F.last(x, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    prev7 = w.rowsBetween(-7, -1)
    prev14 = w.rowsBetween(-14, -1)
    lag_ff = F.lag("_ff", 1).over(w)
    out = src.select(
        *df.columns, *(["_halo"] if hot else []),
        F.lag(x, 1).over(w).alias(f"{name}_Lag_1"),
        F.try_divide(F.col("_ff") - lag_ff, lag_ff).alias(f"{name}_Growth"),
        F.when(F.count(x).over(prev7) >= 2, F.avg(x).over(prev7)).alias(f"{name}_Rolling_Mean_7"),
        F.when(F.count(x).over(prev7) >= 2, F.percentile(x, 0.5).over(prev7))
         .alias(f"{name}_Rolling_Median_7"),
        F.when(F.count(x).over(prev14) >= 3, F.avg(x).over(prev14))
         .alias(f"{name}_Moving_Average_14"),
    )
    if hot:
        out = out.filter(~F.col("_halo")).drop("_halo")
    tcols = [f"{name}_{s}" for s in TEMPORAL_SUFFIXES]
    out = out.select(*[F.when(F.isnan(F.col(c)), None).otherwise(F.col(c)).alias(c)
                       if c in tcols else F.col(c) for c in out.columns])
    if not warmup_fill:
        return out
    from ..session import cut_lineage
    # the fill reads the windowed table several times (group and global medians)
    return warmup_fill_medians(cut_lineage(out), spec.group_keys, tcols)


def warmup_fill_medians(df: DataFrame, group_keys, cols) -> DataFrame:
    """NULL -> median of the group -> median of the column (after the group fill)."""
    from .quantile import grouped_quantiles
    from .rank import null_safe
    group_keys = list(group_keys)
    gmed = grouped_quantiles(df, group_keys, list(cols), [0.5], lambda v, i: f"_gm_{v}")
    out = null_safe(df, gmed, group_keys, "left")
    out = out.select(*[F.coalesce(F.col(c), F.col(f"_gm_{c}")).alias(c) if c in cols
                       else F.col(c) for c in df.columns])
    glob = exact_quantiles(out, cols, [0.5])
    return out.select(*[F.coalesce(F.col(c), F.lit(glob[(c, 0.5)])).alias(c)
                        if c in cols and glob[(c, 0.5)] is not None else F.col(c)
                        for c in out.columns])


# The census mapping (column names of the hospital panel, fixed by the task).
CENSUS_BEDS = ("ICU_Beds", "General_Beds", "Emergency_Beds")


def census_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The full feature set of the census panel."""
    total = row_total(CENSUS_BEDS)
    out = df.withColumn("Total_Beds", total)
    out = out.withColumn("Bed_Utilization_Pct", 100 * ratio("Occupied_Beds", "Total_Beds")) \
             .withColumn("Occupancy_Pct", F.col("Bed_Utilization_Pct")) \
             .withColumn("Staff_per_Bed", ratio("Staff_On_Duty", "Total_Beds")) \
             .withColumn("Doctor_Ratio", ratio("Doctors", "Total_Beds")) \
             .withColumn("Nurse_Ratio", ratio("Nurses", "Total_Beds")) \
             .withColumn("Admissions_per_Bed", ratio("Admissions", "Total_Beds")) \
             .withColumn("Emergency_Load_Interaction",
                         F.col("Emergency_Cases") * F.col("Admissions")) \
             .withColumn("Staffing_Pressure_Interaction", pressure("Occupied_Beds", "Staff_On_Duty")) \
             .withColumn("Admissions_Squared", square("Admissions")) \
             .withColumn("Emergency_Cases_Squared", square("Emergency_Cases"))
    out = calendar_features(out, spec.date_col or "Date", "Holiday")
    return temporal_features(out, spec, "Admissions")


def model_feature_columns(df: DataFrame, excluded=(), categorical=()) -> tuple[list, list]:
    """Numeric predictors (booleans excluded) minus ``excluded``; categoricals present."""
    cats = [c for c in categorical if c in df.columns]
    numeric_types = ("int", "bigint", "double", "float", "smallint", "tinyint")
    nums = [c for c, t in df.dtypes if (t in numeric_types or t.startswith("decimal"))
            and c not in set(excluded) and c not in cats]
    return nums, cats


def feature_family(df: DataFrame, pattern: str) -> DataFrame:
    """Project the columns whose names match a regex (``df.colRegex``)."""
    return df.select(df.colRegex(f"`{pattern}`"))
