"""Cleaning, contract and projection queries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions.exprs import to_date_or_null, to_double
from ..operators import clean
from ..operators.missing import inject_duplicates
from ..operators.rank import positions
from ..sources.tables import ORDER_FACTS_SQL, events_series, order_facts, read_table, \
    scored_labels
from .catalog import query
from .fixtures_sql import md5_sql

_DUP_EVENTS_SQL = f"""
dup AS (SELECT event_id, user_id, ts, event_type, value FROM events
        ORDER BY {md5_sql(['event_id'], 'duplicate')} LIMIT 24),
raw AS (SELECT event_id, user_id, ts, event_type, value FROM events
        UNION ALL SELECT * FROM dup)"""


def _events_with_duplicates(spark, sf_dir):
    return inject_duplicates(events_series(spark, sf_dir), ["event_id"], 24)


@query("c5_duplicate_injection", f"""WITH {_DUP_EVENTS_SQL.strip()}
SELECT event_id, user_id, round(value, 6) AS value FROM raw""")
def c5_duplicate_injection(spark, sf_dir):
    return _events_with_duplicates(spark, sf_dir).select(
        "event_id", "user_id", F.round("value", 6).alias("value"))


@query("b1_deduplicate", f"""WITH {_DUP_EVENTS_SQL.strip()}
SELECT DISTINCT event_id, user_id, ts, event_type, round(value, 6) AS value FROM raw""")
def b1_deduplicate(spark, sf_dir):
    out, _ = clean.deduplicate(_events_with_duplicates(spark, sf_dir))
    return out.select("event_id", "user_id", "ts", "event_type", F.round("value", 6).alias("value"))


@query("b1_duplicates_removed", f"""WITH {_DUP_EVENTS_SQL.strip()}
SELECT (SELECT count(*) FROM raw) AS rows_before,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS rows_after,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))
         AS removed""")
def b1_duplicates_removed(spark, sf_dir):
    _, stats = clean.deduplicate(_events_with_duplicates(spark, sf_dir))
    return stats


@query("b2_date_coercion", """
SELECT event_id,
       CAST(TRY_CAST(substring(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS VARCHAR) AS day_text_date,
       CAST(TRY_CAST(event_type AS DATE) AS VARCHAR) AS junk_text_date
FROM events""")
def b2_date_coercion(spark, sf_dir):
    ev = events_series(spark, sf_dir).select(
        "event_id", F.substring(F.col("ts").cast("string"), 1, 10).alias("day_text_date"),
        F.col("event_type").alias("junk_text_date"))
    out = clean.coerce_types(ev, date_cols=["day_text_date", "junk_text_date"])
    return out.select("event_id", *[F.col(c).cast("string").alias(c)
                                    for c in ("day_text_date", "junk_text_date")])


@query("b3_numeric_coercion", """
SELECT event_id,
       round(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 6) AS value_text_num,
       TRY_CAST(props AS DOUBLE) AS props_num
FROM events""")
def b3_numeric_coercion(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", F.col("value").cast("string").alias("value_text_num"),
        F.col("props").alias("props_num"))
    out = clean.coerce_types(ev, numeric_cols=["value_text_num", "props_num"])
    return out.select("event_id", F.round("value_text_num", 6).alias("value_text_num"),
                      "props_num")


@query("b4_categorical_text", """
SELECT doc_id, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic
FROM labels""")
def b4_categorical_text(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return clean.coerce_types(lab, categorical_cols=["quality", "toxic"])


@query("b5_series_position", """
SELECT event_id, user_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position
FROM events""")
def b5_series_position(spark, sf_dir):
    """Canonical order inside each series: (group, order key, row key)."""
    rows = events_series(spark, sf_dir).select("event_id", "user_id", "ts")
    return positions(rows, ["user_id"], ["ts", "event_id"], "position").select(
        "event_id", "user_id", F.col("position").cast("int").alias("position"))


@query("b6_nonfinite_to_null", """
SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL
                      ELSE round(value, 6) END AS value FROM events""")
def b6_nonfinite_to_null(spark, sf_dir):
    """Infinities and NaN become NULL; the stand-in puts some into ``events.value``."""
    ev = read_table(spark, sf_dir, "events").select("event_id", F.expr(
        "CASE WHEN event_id % 7 = 0 THEN double('Infinity') WHEN event_id % 11 = 0 "
        "THEN double('NaN') ELSE value END").alias("value"))
    return clean.nonfinite_to_null(ev, ["value"]).select(
        "event_id", F.round("value", 6).alias("value"))


@query("b8_drop_incomplete", f"""
WITH of AS ({ORDER_FACTS_SQL})
SELECT o_orderkey, round(qty, 6) AS qty FROM of WHERE n_lines IS NOT NULL AND qty IS NOT NULL""")
def b8_drop_incomplete(spark, sf_dir):
    out = clean.drop_incomplete(order_facts(spark, sf_dir), ["n_lines", "qty"])
    return out.select("o_orderkey", F.round("qty", 6).alias("qty"))


@query("b9_risk_class", """
SELECT event_id, round(value, 6) AS value,
       CASE WHEN value >= 85 THEN 'High' WHEN value >= 70 THEN 'Moderate' ELSE 'Low' END
         AS risk_class
FROM events""")
def b9_risk_class(spark, sf_dir):
    ev = events_series(spark, sf_dir)
    out = clean.with_risk_class(ev, "value", "risk_class")
    return out.select("event_id", F.round("value", 6).alias("value"), "risk_class")


@query("b10_truthy_flags", """
SELECT doc_id, coalesce(quality > 0, false) AS quality_flag,
       coalesce(lower(trim(CAST(toxic AS VARCHAR))) IN ('yes','true','1','holiday',
                'public holiday'), false) AS toxic_flag
FROM labels""")
def b10_truthy_flags(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select(
        "doc_id", "quality", F.col("toxic").cast("string").alias("toxic"))
    out = clean.with_truthy(lab, "quality", "quality_flag")
    out = clean.with_truthy(out, "toxic", "toxic_flag")
    return out.select("doc_id", "quality_flag", "toxic_flag")


_NUM = ["o_totalprice", "n_lines", "qty", "extprice", "avg_disc"]


def _minmax_sql():
    sel = []
    for c in _NUM:
        sel.append(f"""round(CASE WHEN max({c}) OVER () = min({c}) OVER ()
                    OR max({c}) OVER () IS NULL THEN 0.0
                  ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6)
                  AS {c}_Normalized""")
    return f"WITH of AS ({ORDER_FACTS_SQL})\nSELECT o_orderkey, " + ", ".join(sel) + " FROM of"


@query("b13_min_max_normalize", _minmax_sql())
def b13_min_max_normalize(spark, sf_dir):
    out = clean.min_max_normalize(order_facts(spark, sf_dir), _NUM)
    return out.select("o_orderkey", *[F.round(f"{c}_Normalized", 6).alias(f"{c}_Normalized")
                                      for c in _NUM])


def _robust_sql():
    stats = ", ".join(
        f"quantile_cont({c}, 0.5) AS med_{c}, "
        f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr_{c}" for c in _NUM)
    sel = ", ".join(
        f"round(({c} - med_{c}) / CASE WHEN iqr_{c} = 0 OR iqr_{c} IS NULL THEN 1.0 "
        f"ELSE iqr_{c} END, 6) AS {c}_Scaled" for c in _NUM)
    return (f"WITH of AS ({ORDER_FACTS_SQL}), st AS (SELECT {stats} FROM of)\n"
            f"SELECT o_orderkey, {sel} FROM of, st")


@query("b14_robust_scale", _robust_sql())
def b14_robust_scale(spark, sf_dir):
    panel = order_facts(spark, sf_dir).select("o_orderkey", *_NUM).persist(
        StorageLevel.MEMORY_AND_DISK)   # read by several passes
    out = clean.robust_scale(panel, _NUM)
    return out.select("o_orderkey", *[F.round(f"{c}_Scaled", 6).alias(f"{c}_Scaled")
                                      for c in _NUM])


@query("a4_contract_violations", """
SELECT count(*) AS rows,
       CAST(count_if(ts IS NOT NULL AND TRY_CAST(substring(CAST(ts AS VARCHAR), 1, 10) AS DATE)
                IS NULL) AS BIGINT) AS invalid_day,
       CAST(count_if(props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) AS BIGINT) AS non_numeric_props,
       CAST(count_if(value IS NOT NULL AND TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) IS NULL)
         AS BIGINT) AS non_numeric_value
FROM events""")
def a4_contract_violations(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        F.substring(F.col("ts").cast("string"), 1, 10).alias("day"), "props",
        F.col("value").cast("string").alias("value"))
    v = clean.violation_counts(ev, date_cols=["day"], numeric_cols=["props", "value"])
    return v.select(F.col("rows").cast("long").alias("rows"),
                    F.col("invalid_day").cast("long").alias("invalid_day"),
                    F.col("non_numeric_props").cast("long").alias("non_numeric_props"),
                    F.col("non_numeric_value").cast("long").alias("non_numeric_value"))


@query("a5_preview", """
SELECT substring(CAST(o_orderkey AS VARCHAR), 1, 28) AS o_orderkey,
       substring(CAST(o_custkey AS VARCHAR), 1, 28) AS o_custkey,
       substring(o_orderstatus, 1, 28) AS o_orderstatus,
       substring(o_orderpriority, 1, 28) AS o_orderpriority
FROM orders ORDER BY orders.o_orderkey LIMIT 80""")
def a5_preview(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return clean.preview(o, ["o_orderkey"])


@query("a4_scored_labels_rows", """
SELECT count(*) AS rows, CAST(count_if(actual IS NULL) AS BIGINT) AS null_actual,
       CAST(count_if(predicted IS NULL) AS BIGINT) AS null_predicted
FROM (SELECT CAST(quality AS VARCHAR) AS actual, CAST(toxic AS VARCHAR) AS predicted FROM labels)""")
def a4_scored_labels_rows(spark, sf_dir):
    s = scored_labels(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("actual").isNull()).cast("long").alias("null_actual"),
                 F.count_if(F.col("predicted").isNull()).cast("long").alias("null_predicted"))


_ = (to_date_or_null, to_double)


def _scratch(spark, name):
    """A folder under the session's checkpoint dir (shared storage on a cluster)."""
    import uuid
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("a1_csv_scan", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Date,
       round(o_totalprice, 2) AS o_totalprice
FROM orders""")
def a1_csv_scan(spark, sf_dir):
    """orders written as CSV (A2 sink) and read back by the A1 scan with its date contract."""
    from ..sources import files
    path = _scratch(spark, "orders-csv")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), "o_totalprice")
    files.write_table(o, path, fmt="csv")
    df = files.load_panel_csv(spark, path, schema="o_orderkey long, Date string, o_totalprice double")
    return df.select("o_orderkey", F.col("Date").cast("string").alias("Date"),
                     F.round("o_totalprice", 2).alias("o_totalprice"))


@query("a3_run_summary", """
SELECT '{"customers": ' || (SELECT count(*) FROM customer) || ', "orders": {"first": "'
       || (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) || '", "rows": '
       || (SELECT count(*) FROM orders) || '}}' AS summary""")
def a3_run_summary(spark, sf_dir):
    """A run summary of table counts, written as one JSON document and read back (A3)."""
    from ..sources import files
    path = _scratch(spark, "summary")
    orders = read_table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("rows"), F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first")).first()
    files.write_summary(spark, {"orders": orders.asDict(), "customers": read_table(
        spark, sf_dir, "customer").count()}, path)
    return spark.read.text(path).withColumnRenamed("value", "summary")


@query("b7_present_columns", "SELECT event_id, user_id, round(value, 6) AS value FROM events")
def b7_present_columns(spark, sf_dir):
    """Of the columns that a specification names, those that the table has."""
    from ..spec import PanelSpec
    df = read_table(spark, sf_dir, "events")
    spec = PanelSpec(key=("event_id",), group_keys=("ward", "user_id"), numeric=("beds", "value")).present(df)
    return df.select(*spec.key, *spec.group_keys, *[F.round(c, 6).alias(c) for c in spec.numeric])


@query("b11_first_available", """
SELECT user_id, 'value' AS measure, round(avg(value), 6) AS mean FROM events GROUP BY user_id""")
def b11_first_available(spark, sf_dir):
    """The mean by group of the first measure of a list that the table has."""
    df = read_table(spark, sf_dir, "events")
    measure = clean.first_available(df, ["occupancy_pct", "occupancy", "value", "event_id"])
    return df.groupBy("user_id").agg(F.lit(measure).alias("measure"), F.round(F.avg(measure), 6).alias("mean"))


@query("b12_feature_roles", """
SELECT * FROM (SELECT 'c_acctbal' AS feature, 'numeric' AS role, count(c_acctbal) AS known FROM customer
  UNION ALL SELECT 'c_mktsegment', 'categorical', count(c_mktsegment) FROM customer)""")
def b12_feature_roles(spark, sf_dir):
    """Predictors of a table by role, with their known values."""
    from ..operators.features import model_feature_columns
    df = read_table(spark, sf_dir, "customer")
    numeric, categorical = model_feature_columns(df, ("c_custkey", "c_nationkey"), ("c_mktsegment", "c_ward"))
    role = {c: "numeric" for c in numeric} | {c: "categorical" for c in categorical}
    known = df.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.lit(r).alias("role"), F.col(c).isNotNull().cast("long").alias("k"))
        for c, r in role.items()])).alias("x"))
    return known.groupBy("x.feature", "x.role").agg(F.sum("x.k").alias("known"))
