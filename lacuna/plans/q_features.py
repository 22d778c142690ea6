"""Feature, outlier, EDA and baseline queries (G, F1, I, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import baselines, eda, features, outliers
from ..operators.clean import drop_incomplete
from ..sources.tables import (DAILY_ORDERS_SQL, ORDER_FACTS_SQL, daily_orders, events_series,
                              order_facts, read_table)
from ..spec import DAILY_ORDERS
from .catalog import query
from .fixtures_sql import md5_sql

OF = f"WITH of AS ({ORDER_FACTS_SQL})\n"
NUM = ["o_totalprice", "n_lines", "qty", "extprice", "avg_disc"]


def _r(c, d=6):
    return F.round(c, d).alias(c)


# ------------------------------------------------------------------ G1-G6
@query("g1_g6_row_features", OF + """
SELECT o_orderkey,
  round(greatest(coalesce(n_lines, 0) + coalesce(qty, 0), 1), 6) AS total_units,
  round(100 * extprice / greatest(coalesce(n_lines, 0) + coalesce(qty, 0), 1), 6) AS price_pct,
  round(o_totalprice / greatest(coalesce(n_lines, 0) + coalesce(qty, 0), 1), 6) AS price_per_unit,
  round(qty * n_lines, 6) AS load_interaction,
  round(extprice / greatest(n_lines, 1), 6) AS pressure,
  round(qty * qty, 6) AS qty_squared
FROM of""")
def g1_g6_row_features(spark, sf_dir):
    df = order_facts(spark, sf_dir)
    total = features.row_total(["n_lines", "qty"])
    out = df.withColumn("total_units", total).select(
        "o_orderkey", "total_units",
        (100 * features.ratio("extprice", "total_units")).alias("price_pct"),
        features.ratio("o_totalprice", "total_units").alias("price_per_unit"),
        (F.col("qty") * F.col("n_lines")).alias("load_interaction"),
        features.pressure("extprice", "n_lines").alias("pressure"),
        features.square("qty").alias("qty_squared"))
    return out.select("o_orderkey", *[_r(c) for c in out.columns if c != "o_orderkey"])


# ------------------------------------------------------------------ G7-G10
@query("g7_g10_calendar_features", """
SELECT o_orderkey, month(o_orderdate) AS Month, quarter(o_orderdate) AS Quarter,
  isodow(o_orderdate) - 1 AS Day_of_Week,
  CASE WHEN isodow(o_orderdate) - 1 IN (5, 6) THEN 1 ELSE 0 END AS Weekend_Indicator,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
       WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
       WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS Season
FROM orders""")
def g7_g10_calendar_features(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    out = features.calendar_features(o, "o_orderdate")
    return out.select("o_orderkey", *[F.col(c).cast("bigint").alias(c) for c in
                                      ("Month", "Quarter", "Day_of_Week", "Weekend_Indicator")],
                      "Season")


# ------------------------------------------------------------------ G11-G16
def _temporal_sql():
    w = "PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderpriority"
    base = f"""WITH d AS ({DAILY_ORDERS_SQL}),
f AS (SELECT *, last_value(total IGNORE NULLS) OVER ({w}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM d),
t AS (SELECT o_orderpriority, o_orderdate,
  lag(total, 1) OVER ({w}) AS total_Lag_1,
  CASE WHEN lag(ff, 1) OVER ({w}) = 0 THEN NULL
       ELSE (ff - lag(ff, 1) OVER ({w})) / lag(ff, 1) OVER ({w}) END AS total_Growth,
  CASE WHEN count(total) OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 2
       THEN avg(total) OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END
       AS total_Rolling_Mean_7,
  CASE WHEN count(total) OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 2
       THEN quantile_cont(total, 0.5) OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END
       AS total_Rolling_Median_7,
  CASE WHEN count(total) OVER ({w} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) >= 3
       THEN avg(total) OVER ({w} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) END
       AS total_Moving_Average_14
FROM f)"""
    cols = ["total_Lag_1", "total_Growth", "total_Rolling_Mean_7", "total_Rolling_Median_7",
            "total_Moving_Average_14"]
    g = ", ".join(f"coalesce({c}, quantile_cont({c}, 0.5) OVER (PARTITION BY o_orderpriority))"
                  f" AS {c}" for c in cols)
    fin = ", ".join(f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM g)), 6) AS {c}"
                    for c in cols)
    return (base + f",\ng AS (SELECT o_orderpriority, o_orderdate, {g} FROM t)\n"
            f"SELECT o_orderpriority, CAST(o_orderdate AS VARCHAR) AS o_orderdate, {fin} FROM g")


@query("g11_g16_temporal_features", _temporal_sql())
def g11_g16_temporal_features(spark, sf_dir):
    d = daily_orders(spark, sf_dir)
    out = features.temporal_features(d, DAILY_ORDERS, "total")
    cols = [f"total_{s}" for s in features.TEMPORAL_SUFFIXES]
    return out.select("o_orderpriority", F.col("o_orderdate").cast("string").alias("o_orderdate"),
                      *[_r(c) for c in cols])


# ------------------------------------------------------------------ F1
def _iqr_sql():
    parts = []
    for c in NUM:
        parts.append(f"""SELECT '{c}' AS feature, lo AS lower_bound, hi AS upper_bound,
  CAST(count_if({c} < lo OR {c} > hi) AS BIGINT) AS outlier_count,
  coalesce(count_if({c} < lo OR {c} > hi) * 100.0 / nullif(count({c}), 0), 0.0) AS outlier_rate_pct
FROM of, (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) -
                 quantile_cont({c}, 0.25)) AS lo,
                 quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) -
                 quantile_cont({c}, 0.25)) AS hi FROM of) q GROUP BY lo, hi""")
    body = "\nUNION ALL\n".join(parts)
    return (OF + f", r AS ({body})\nSELECT feature, round(lower_bound, 6) AS lower_bound, "
            "round(upper_bound, 6) AS upper_bound, outlier_count, "
            "round(outlier_rate_pct, 6) AS outlier_rate_pct FROM r")


@query("f1_iqr_outliers", _iqr_sql().replace("\n, r AS", ", r AS"))
def f1_iqr_outliers(spark, sf_dir):
    s = outliers.iqr_summary(order_facts(spark, sf_dir), NUM)
    return s.select("feature", _r("lower_bound"), _r("upper_bound"), "outlier_count",
                    _r("outlier_rate_pct"))


@query("f2_isolation_forest")
def f2_isolation_forest(spark, sf_dir):
    """Anomaly score of every order and the flag of the most isolated 2 %."""
    return outliers.isolation_forest_flags(order_facts(spark, sf_dir), ["o_orderkey"], NUM)


@query("g9_holiday_indicator", OF + """
SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) = 12 AND day(o_orderdate) = 25 THEN 1
                             ELSE 0 END AS INTEGER) AS Holiday_Indicator FROM of""")
def g9_holiday_indicator(spark, sf_dir):
    """Holiday flag from a Yes / No / NULL column (the stand-in marks December 25)."""
    day = F.to_date("o_orderdate")
    df = order_facts(spark, sf_dir).withColumn("Holiday", F.when(
        (F.month(day) == 12) & (F.dayofmonth(day) == 25), "Yes").when(F.month(day) > 6, "No"))
    return features.calendar_features(df, "o_orderdate", "Holiday").select(
        "o_orderkey", "Holiday_Indicator")


# ------------------------------------------------------------------ I1-I10
def _corr_sql():
    parts = []
    for a in NUM:
        for b in NUM:
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                         f"round(corr({a}, {b}), 6) AS corr FROM of")
    return OF + "\nUNION ALL\n".join(parts)


@query("i1_correlation_matrix", _corr_sql())
def i1_correlation_matrix(spark, sf_dir):
    return eda.correlation_matrix(order_facts(spark, sf_dir), NUM).select(
        "feature_a", "feature_b", _r("corr"))


@query("i2_histogram", """
WITH mm AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 35)), 34) AS INTEGER) AS bin, lo, hi
      FROM events, mm WHERE value IS NOT NULL)
SELECT bin, round(lo + bin * ((hi - lo) / 35), 6) AS bin_lower,
       round(lo + (bin + 1) * ((hi - lo) / 35), 6) AS bin_upper, CAST(count(*) AS BIGINT) AS count
FROM b GROUP BY bin, lo, hi""")
def i2_histogram(spark, sf_dir):
    h = eda.histogram(events_series(spark, sf_dir), "value", 35)
    return h.select("bin", _r("bin_lower"), _r("bin_upper"), "count")


@query("i3_five_number_summary", """
SELECT event_type, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
       round(max(value), 6) AS max, CAST(count(value) AS BIGINT) AS n
FROM events GROUP BY event_type""")
def i3_five_number_summary(spark, sf_dir):
    s = eda.five_number_summary(events_series(spark, sf_dir), "value", "event_type")
    return s.select("event_type", *[_r(c) for c in ("min", "q1", "median", "q3", "max")], "n")


@query("i4_mean_by_group", OF + """
SELECT o_orderstatus, round(avg(extprice), 6) AS mean_extprice, CAST(count(*) AS BIGINT) AS n
FROM of GROUP BY o_orderstatus""")
def i4_mean_by_group(spark, sf_dir):
    m = eda.mean_by(order_facts(spark, sf_dir), "extprice", "o_orderstatus")
    return m.select("o_orderstatus", _r("mean_extprice"), "n")


@query("i5_daily_trend", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS period, round(avg(value), 6) AS mean_value,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY CAST(ts AS DATE)""")
def i5_daily_trend(spark, sf_dir):
    t = eda.trend(events_series(spark, sf_dir), "value", "ts", "day")
    return t.select(F.col("period").cast("string").alias("period"), _r("mean_value"), "n")


@query("i5_monthly_trend", """
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS period,
       round(avg(o_totalprice), 6) AS mean_o_totalprice, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1""")
def i5_monthly_trend(spark, sf_dir):
    t = eda.trend(read_table(spark, sf_dir, "orders"), "o_totalprice", "o_orderdate", "month")
    return t.select(F.col("period").cast("string").alias("period"), _r("mean_o_totalprice"), "n")


@query("i6_mean_by_two_keys", OF + """
SELECT o_orderstatus, c_mktsegment, round(avg(o_totalprice), 6) AS mean_o_totalprice,
       CAST(count(*) AS BIGINT) AS n
FROM of GROUP BY CUBE (o_orderstatus, c_mktsegment)""")
def i6_mean_by_two_keys(spark, sf_dir):
    c = eda.cube_means(order_facts(spark, sf_dir), "o_totalprice", "o_orderstatus", "c_mktsegment")
    return c.select("o_orderstatus", "c_mktsegment", _r("mean_o_totalprice"), "n")


@query("i7_scatter_sample", OF + f"""
SELECT o_orderkey, round(qty, 6) AS qty, round(extprice, 6) AS extprice FROM of
ORDER BY {md5_sql(['o_orderkey'], 'scatter')} LIMIT 2500""")
def i7_scatter_sample(spark, sf_dir):
    s = eda.scatter_sample(order_facts(spark, sf_dir), ["o_orderkey"], ["qty", "extprice"])
    return s.select("o_orderkey", _r("qty"), _r("extprice"))


@query("i7_pair_sample", OF + f"""
SELECT o_orderkey, {", ".join(f"round({c}, 6) AS {c}" for c in NUM)} FROM of
ORDER BY {md5_sql(['o_orderkey'], 'scatter')} LIMIT 1200""")
def i7_pair_sample(spark, sf_dir):
    """The five columns of the pair plot on an exact sample (the sample is the feature)."""
    s = eda.scatter_sample(order_facts(spark, sf_dir), ["o_orderkey"], NUM, 1200)
    return s.select("o_orderkey", *[_r(c) for c in NUM])


@query("i8_mean_by_group_desc", OF + """
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean_o_totalprice,
       CAST(count(*) AS BIGINT) AS n
FROM of GROUP BY o_orderpriority ORDER BY mean_o_totalprice DESC""")
def i8_mean_by_group_desc(spark, sf_dir):
    m = eda.mean_by(order_facts(spark, sf_dir), "o_totalprice", "o_orderpriority", descending=True)
    return m.select("o_orderpriority", _r("mean_o_totalprice"), "n")


@query("i9_feature_family", """
SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, round(o_totalprice, 6)
  AS o_totalprice, o_custkey FROM orders""")
def i9_feature_family(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    fam = features.feature_family(o, "o_.*")
    return fam.select(*[_r(c) if c == "o_totalprice" else F.col(c) for c in fam.columns])


@query("i10_schema_profile", OF + """
SELECT column_name, data_type, CAST(missing_count AS BIGINT) AS missing_count FROM (
  SELECT 'n_lines' AS column_name, 'double' AS data_type, count_if(n_lines IS NULL) AS missing_count
  FROM of UNION ALL
  SELECT 'qty', 'double', count_if(qty IS NULL) FROM of UNION ALL
  SELECT 'c_mktsegment', 'string', count_if(c_mktsegment IS NULL) FROM of UNION ALL
  SELECT 'o_orderkey', 'bigint', count_if(o_orderkey IS NULL) FROM of)""")
def i10_schema_profile(spark, sf_dir):
    df = order_facts(spark, sf_dir).select("n_lines", "qty", "c_mktsegment", "o_orderkey")
    return eda.schema_profile(df).select("column_name", "data_type", "missing_count")


# ------------------------------------------------------------------ L1-L4
_RULE_MAP = {"Admissions": "qty", "Emergency_Cases": "n_lines", "Doctors": "avg_disc"}


@query("l1_rule_baseline", OF + """
SELECT o_orderkey, round(s, 6) AS rule_score,
  CASE WHEN s >= 85 THEN 'High' WHEN s >= 70 THEN 'Moderate' ELSE 'Low' END AS rule_class
FROM (SELECT o_orderkey, 52.0 + 0.65 * coalesce(qty, 20.0) + 0.38 * coalesce(n_lines, 20.0)
        + -0.3 * greatest(35.0, 1.0) + -0.18 * 20.0
        + 1.2 * greatest(coalesce(avg_disc, 8.0), 1.0) AS s FROM of)""")
def l1_rule_baseline(spark, sf_dir):
    out = baselines.rule_predict(order_facts(spark, sf_dir), _RULE_MAP)
    return out.select("o_orderkey", _r("rule_score"), "rule_class")


_CF = ["qty", "extprice", "n_lines"]


def _centroid_inputs(spark, sf_dir):
    return drop_incomplete(order_facts(spark, sf_dir), _CF)


_CENT_SQL = OF + """, cc AS (SELECT * FROM of WHERE qty IS NOT NULL AND extprice IS NOT NULL
                         AND n_lines IS NOT NULL),
cent AS (SELECT o_orderstatus AS label, avg(qty) AS m_qty, avg(extprice) AS m_extprice,
                avg(n_lines) AS m_n_lines FROM cc GROUP BY o_orderstatus),
sc AS (SELECT coalesce(nullif(stddev_pop(qty), 0), 1.0) AS s_qty,
              coalesce(nullif(stddev_pop(extprice), 0), 1.0) AS s_extprice,
              coalesce(nullif(stddev_pop(n_lines), 0), 1.0) AS s_n_lines FROM cc),
dist AS (SELECT cc.o_orderkey, cent.label,
   ((qty - m_qty) / s_qty) * ((qty - m_qty) / s_qty)
   + ((extprice - m_extprice) / s_extprice) * ((extprice - m_extprice) / s_extprice)
   + ((n_lines - m_n_lines) / s_n_lines) * ((n_lines - m_n_lines) / s_n_lines) AS d
   FROM cc, cent, sc)"""


@query("l2_centroid_fit", _CENT_SQL + """
SELECT label, feature, round(centroid, 6) AS centroid, round(scale, 6) AS scale FROM (
  SELECT label, 'qty' AS feature, m_qty AS centroid, s_qty AS scale FROM cent, sc UNION ALL
  SELECT label, 'extprice', m_extprice, s_extprice FROM cent, sc UNION ALL
  SELECT label, 'n_lines', m_n_lines, s_n_lines FROM cent, sc)""")
def l2_centroid_fit(spark, sf_dir):
    m = baselines.centroid_fit(_centroid_inputs(spark, sf_dir), _CF, "o_orderstatus")
    rows = [(lab, f, float(v[f]), float(m["scales"][f]))
            for lab, v in m["centroids"].items() for f in _CF]
    out = spark.createDataFrame(rows, "label string, feature string, centroid double, scale double")
    return out.select("label", "feature", _r("centroid"), _r("scale"))


@query("l3_centroid_predict", _CENT_SQL + """
SELECT o_orderkey, label AS centroid_class FROM (
  SELECT o_orderkey, label, row_number() OVER (PARTITION BY o_orderkey ORDER BY d, label) AS r
  FROM dist) WHERE r = 1""")
def l3_centroid_predict(spark, sf_dir):
    df = _centroid_inputs(spark, sf_dir)
    m = baselines.centroid_fit(df, _CF, "o_orderstatus")
    return baselines.centroid_predict(df, m).select("o_orderkey", "centroid_class")


@query("l4_centroid_proba", _CENT_SQL + """
SELECT o_orderkey, round(max(CASE WHEN label = 'F' THEN p END), 6) AS proba_F,
       round(max(CASE WHEN label = 'O' THEN p END), 6) AS proba_O,
       round(max(CASE WHEN label = 'P' THEN p END), 6) AS proba_P
FROM (SELECT o_orderkey, label, (1.0 / (1.0 + d)) / sum(1.0 / (1.0 + d)) OVER
        (PARTITION BY o_orderkey) AS p FROM dist) GROUP BY o_orderkey""")
def l4_centroid_proba(spark, sf_dir):
    df = _centroid_inputs(spark, sf_dir)
    m = baselines.centroid_fit(df, _CF, "o_orderstatus")
    out = baselines.centroid_proba(df, m)
    return out.select("o_orderkey", *[_r(f"proba_{c}") for c in ("F", "O", "P")])
