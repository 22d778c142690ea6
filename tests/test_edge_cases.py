"""Hand-written edge cases, one per rule (FIXTURES.md §4)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lacuna.functions import pvalues as pv
from lacuna.functions.exprs import risk_class, truthy
from lacuna.operators import clean, features, outliers
from lacuna.operators.impute import fill_categories, impute, numeric_modes, repair_with_policy
from lacuna.operators.missing import mask_column
from lacuna.spec import PanelSpec

SPEC = PanelSpec(key=("id",), group_keys=("g",), order_key=("t",), numeric=("x",),
                 categorical=("c",))
SCHEMA = "id long, g string, t long, x double, c string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _vals(df, col="x"):
    return [r[col] for r in df.orderBy("id").collect()]


@pytest.fixture
def gaps(spark):
    # group a: leading + trailing gaps; group b: all NULL; group c: single row
    rows = [(1, "a", 1, None, "p"), (2, "a", 2, 10.0, None), (3, "a", 3, None, "q"),
            (4, "a", 4, 20.0, "q"), (5, "a", 5, None, "p"),
            (6, "b", 1, None, None), (7, "b", 2, None, "p"),
            (8, "c", 1, 5.0, "p")]
    return _df(spark, rows)


def test_ffill_bfill_edges_fall_back_to_median(gaps):
    med = 10.0  # median of 10, 20, 5
    assert _vals(impute(gaps, SPEC, "Forward Fill")) == [med, 10, 10, 20, 20, med, med, 5]
    assert _vals(impute(gaps, SPEC, "Backward Fill")) == [10, 10, 20, 20, med, med, med, 5]


def test_linear_interpolation_holds_edges(gaps):
    assert _vals(impute(gaps, SPEC, "Linear Interpolation")) == [10, 10, 15, 20, 20, 10, 10, 5]


def test_polynomial_two_knots_is_linear(gaps):
    assert _vals(impute(gaps, SPEC, "Polynomial Interpolation")) == [10, 10, 15, 20, 10, 10, 10, 5]


def test_categories_mode_tie_smallest_and_unknown(spark):
    df = spark.createDataFrame([(1, "z"), (2, "a"), (3, None), (4, "z"), (5, "a")],
                               "id long, c string")
    out = fill_categories(df, ["c"])
    assert [r["c"] for r in out.orderBy("id").collect()] == ["z", "a", "a", "z", "a"]
    empty = spark.createDataFrame([(1, None)], "id long, c string")
    assert fill_categories(empty, ["c"]).first()["c"] == "Unknown"


def test_numeric_mode_tie_smallest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,), (2.0,)], "x double")
    assert numeric_modes(df, ["x"])["x"] == 1.0


def test_constant_and_all_null_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 2.0, None)], "id long, k double, z double")
    out = clean.min_max_normalize(df, ["k", "z"]).collect()
    assert all(r["k_Normalized"] == 0.0 and r["z_Normalized"] == 0.0 for r in out)
    spec = PanelSpec(key=("id",), numeric=("z",))
    assert _vals(impute(df, spec, "Mean"), "z") == [0.0, 0.0]   # all NULL -> 0.0


def test_inf_and_nan_become_null(spark):
    df = spark.createDataFrame([(1, "a", 1, float("inf"), "p"), (2, "a", 2, float("nan"), "p"),
                                (3, "a", 3, 4.0, "p")], SCHEMA)
    assert _vals(impute(df, SPEC, "Mean")) == [4.0, 4.0, 4.0]


def test_growth_zero_denominator_is_null(spark):
    df = _df(spark, [(1, "a", 1, 0.0, "p"), (2, "a", 2, 5.0, "p"), (3, "a", 3, 10.0, "p")])
    out = features.temporal_features(df, SPEC, "x", warmup_fill=False)
    g = [r["x_Growth"] for r in out.orderBy("id").collect()]
    assert g[0] is None and g[1] is None and g[2] == 1.0


def test_text_in_numeric_and_invalid_date(spark):
    df = spark.createDataFrame([("1.5", "2024-02-30"), ("abc", "2024-02-28")], "n string, d string")
    out = clean.coerce_types(df, date_cols=["d"], numeric_cols=["n"]).collect()
    assert out[0]["n"] == 1.5 and out[1]["n"] is None
    assert out[0]["d"] is None and out[1]["d"] == dt.date(2024, 2, 28)
    with pytest.raises(clean.ContractError):
        clean.check_contract(clean.coerce_types(df, date_cols=["d"]), required=["d"],
                             date_cols=["d"])
    with pytest.raises(clean.ContractError):
        clean.check_contract(df, required=["Date"])


def test_duplicate_rows_with_null_are_removed(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a long, b string")
    out, stats = clean.deduplicate(df)
    assert out.count() == 2
    assert stats.first()["removed"] == 1


def test_risk_class_thresholds(spark):
    df = spark.createDataFrame([(69.99,), (70.0,), (84.99,), (85.0,), (None,)], "r double")
    got = [r[0] for r in df.select(risk_class("r")).collect()]
    assert got == ["Low", "Moderate", "Moderate", "High", "Low"]


def test_truthy_normaliser(spark):
    df = spark.createDataFrame([(" Yes ",), ("public holiday",), ("no",), (None,), ("1",)], "s string")
    assert [r[0] for r in df.select(truthy("s")).collect()] == [True, True, False, False, True]


def test_mask_column_exact_count(spark):
    df = spark.range(0, 1000).withColumn("x", F.col("id").cast("double"))
    out, k = mask_column(df, ["id"], "x", 0.07)
    assert k == 70 and out.filter(F.col("x").isNull()).count() == 70
    out, k = mask_column(df, ["id"], "x", 0.1, eligible=F.col("id") < 15)
    assert k == 1 and out.filter(F.col("x").isNull()).count() == 1


def test_policy_repair_order(gaps):
    out = repair_with_policy(gaps, SPEC, {"x": "Linear Interpolation"})
    assert _vals(out) == [10, 10, 15, 20, 20, 10, 10, 5]
    assert out.filter(F.col("c").isNull()).count() == 0


def test_iqr_summary_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (100.0, None), (3.0, None)],
                               "a double, b double")
    rows = {r["feature"]: r for r in outliers.iqr_summary(df, ["a", "b"]).collect()}
    assert rows["b"]["lower_bound"] is None and rows["b"]["outlier_count"] == 0
    assert rows["a"]["outlier_count"] == 1 and rows["a"]["outlier_rate_pct"] == 25.0


def test_pvalue_tails():
    assert abs(pv.t_sf2(2.0, 10) - 0.0733880347707) < 1e-9
    assert abs(pv.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(pv.f_sf(3.0, 2, 20) - 0.0725381502864) < 1e-9
    assert abs(pv.norm_ppf(0.975) - 1.959963984540054) < 1e-12
    assert abs(pv.norm_sf(1.959963984540054) - 0.025) < 1e-12
    assert math.isclose(sum(pv.shapiro_coefficients(10)[i] ** 2 for i in range(10)), 1.0,
                        rel_tol=1e-6)


def test_calendar_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    out = features.calendar_features(df, "d").collect()
    assert [r["Day_of_Week"] for r in out] == [0, 6]
    assert [r["Weekend_Indicator"] for r in out] == [0, 1]
    assert out[0]["Season"] == "Winter"
