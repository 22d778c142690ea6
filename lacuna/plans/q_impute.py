"""Imputation queries (D1-D7, D13-D15) on masked driver panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.impute import impute, repair_with_policy
from ..spec import EVENTS, ORDER_FACTS
from .catalog import query
from .fixtures_sql import MASKED_EVENTS, masked_order_facts
from .panels import masked_events, masked_order_facts as spark_masked_order_facts

EV_OUT = ["event_id", "user_id", "was_masked"]


def _events_repair(method):
    def run(spark, sf_dir):
        df = masked_events(spark, sf_dir)
        out = impute(df, EVENTS, method)
        return out.select(*EV_OUT, F.round("value", 6).alias("value"))
    return run


def _sql(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes.strip()}" if ctes else ""
    return (f"WITH {MASKED_EVENTS.strip()},\n"
            f"med AS (SELECT quantile_cont(value, 0.5) AS m FROM mev){extra}\n{body}")


W_BACK = ("OVER (PARTITION BY user_id ORDER BY ts, event_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
W_FWD = ("OVER (PARTITION BY user_id ORDER BY ts, event_id "
         "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
W_SBACK = ("OVER (PARTITION BY user_id ORDER BY ts, event_id "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
W_SFWD = ("OVER (PARTITION BY user_id ORDER BY ts, event_id "
          "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)")

query("d1_mean_fill", _sql("""
SELECT event_id, user_id, was_masked,
       round(coalesce(value, (SELECT avg(value) FROM mev), (SELECT m FROM med), 0.0), 6) AS value
FROM mev"""))(_events_repair("Mean"))

query("d2_median_fill", _sql("""
SELECT event_id, user_id, was_masked,
       round(coalesce(value, (SELECT m FROM med), 0.0), 6) AS value
FROM mev"""))(_events_repair("Median"))

query("d3_mode_fill", _sql("""
SELECT event_id, user_id, was_masked,
       round(coalesce(value, (SELECT mv FROM mode_v), (SELECT m FROM med), 0.0), 6) AS value
FROM mev""", """mode_v AS (SELECT value AS mv FROM mev WHERE value IS NOT NULL
            GROUP BY value ORDER BY count(*) DESC, value LIMIT 1)"""))(_events_repair("Mode"))

query("d4_forward_fill", _sql(f"""
SELECT event_id, user_id, was_masked,
       round(coalesce(last_value(value IGNORE NULLS) {W_BACK}, (SELECT m FROM med), 0.0), 6)
         AS value
FROM mev"""))(_events_repair("Forward Fill"))

query("d5_backward_fill", _sql(f"""
SELECT event_id, user_id, was_masked,
       round(coalesce(first_value(value IGNORE NULLS) {W_FWD}, (SELECT m FROM med), 0.0), 6)
         AS value
FROM mev"""))(_events_repair("Backward Fill"))

_NEIGHBOURS = f"""
pos AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM mev),
nb AS (
  SELECT *,
    last_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) {W_BACK} AS pi,
    last_value(value IGNORE NULLS) {W_BACK} AS pv,
    first_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) {W_FWD} AS ni,
    first_value(value IGNORE NULLS) {W_FWD} AS nv,
    last_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) {W_SBACK} AS bi,
    last_value(value IGNORE NULLS) {W_SBACK} AS bv,
    first_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) {W_SFWD} AS ai,
    first_value(value IGNORE NULLS) {W_SFWD} AS av
  FROM pos)"""

_LINEAR = """CASE WHEN value IS NOT NULL THEN value
            WHEN pi IS NOT NULL AND ni IS NOT NULL AND ni <> pi
              THEN pv + (nv - pv) * (i - pi) / (ni - pi)
            WHEN pi IS NOT NULL THEN pv ELSE nv END"""

query("d6_linear_interpolation", _sql(f"""
SELECT event_id, user_id, was_masked,
       round(coalesce({_LINEAR}, (SELECT m FROM med), 0.0), 6) AS value
FROM nb""", _NEIGHBOURS))(_events_repair("Linear Interpolation"))


def _quad_sql(x, x0, y0, x1, y1, x2, y2):
    return (f"({y0} * ({x} - {x1}) * ({x} - {x2}) / (({x0} - {x1}) * ({x0} - {x2}))"
            f" + {y1} * ({x} - {x0}) * ({x} - {x2}) / (({x1} - {x0}) * ({x1} - {x2}))"
            f" + {y2} * ({x} - {x0}) * ({x} - {x1}) / (({x2} - {x0}) * ({x2} - {x1})))")


_NB2 = f"""nb2 AS (
  SELECT *,
    last_value(CASE WHEN value IS NOT NULL THEN bi END IGNORE NULLS) {W_BACK} AS ppi,
    last_value(CASE WHEN value IS NOT NULL THEN bv END IGNORE NULLS) {W_BACK} AS ppv,
    first_value(CASE WHEN value IS NOT NULL THEN ai END IGNORE NULLS) {W_FWD} AS nni,
    first_value(CASE WHEN value IS NOT NULL THEN av END IGNORE NULLS) {W_FWD} AS nnv
  FROM nb)"""

query("d7_polynomial_interpolation", _sql(f"""
SELECT event_id, user_id, was_masked,
  round(coalesce(CASE
    WHEN value IS NOT NULL THEN value
    WHEN pi IS NOT NULL AND ni IS NOT NULL AND ppi IS NOT NULL
      THEN {_quad_sql('CAST(i AS DOUBLE)', 'ppi', 'ppv', 'pi', 'pv', 'ni', 'nv')}
    WHEN pi IS NOT NULL AND ni IS NOT NULL AND nni IS NOT NULL
      THEN {_quad_sql('CAST(i AS DOUBLE)', 'pi', 'pv', 'ni', 'nv', 'nni', 'nnv')}
    WHEN pi IS NOT NULL AND ni IS NOT NULL THEN {_LINEAR}
    END, (SELECT m FROM med), 0.0), 6) AS value
FROM nb2""", _NEIGHBOURS + ",\n" + _NB2))(
    _events_repair("Polynomial Interpolation"))


# Categorical mode fill on a masked categorical column (ties -> smallest)
def _masked_event_types(spark, sf_dir):
    from ..operators.missing import mask_column
    from ..sources.tables import events_series
    ev = events_series(spark, sf_dir)
    out, _ = mask_column(ev, ["event_id"], "event_type", 0.12, flag="was_masked")
    return out


@query("d13_category_mode_fill", f"""
WITH r AS (
  SELECT event_id, user_id, event_type,
         row_number() OVER (ORDER BY md5(concat_ws('|', CAST(event_id AS VARCHAR),
                                                    'event_type', '42'))) AS _rn,
         count(*) OVER () AS _n
  FROM events),
m AS (SELECT event_id, user_id,
             CASE WHEN _rn <= least(_n, greatest(1, CAST(floor(_n * 0.12) AS BIGINT)))
                  THEN NULL ELSE event_type END AS event_type,
             _rn <= least(_n, greatest(1, CAST(floor(_n * 0.12) AS BIGINT))) AS was_masked
      FROM r),
mo AS (SELECT event_type AS mv FROM m WHERE event_type IS NOT NULL
       GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, user_id, was_masked,
       coalesce(event_type, (SELECT mv FROM mo), 'Unknown') AS event_type
FROM m""")
def d13_category_mode_fill(spark, sf_dir):
    from ..operators.impute import fill_categories
    df = _masked_event_types(spark, sf_dir)
    return fill_categories(df, ["event_type"]).select(*EV_OUT, "event_type")


# Numeric fallback (median else 0.0) on order_facts natural + masked gaps
@query("d14_numeric_fallback", f"""
WITH {masked_order_facts()}
SELECT o_orderkey,
  round(coalesce(extprice, (SELECT quantile_cont(extprice, 0.5) FROM mof), 0.0), 6) AS extprice,
  round(coalesce(qty, (SELECT quantile_cont(qty, 0.5) FROM mof), 0.0), 6) AS qty,
  round(coalesce(avg_disc, (SELECT quantile_cont(avg_disc, 0.5) FROM mof), 0.0), 6) AS avg_disc
FROM mof""")
def d14_numeric_fallback(spark, sf_dir):
    df = spark_masked_order_facts(spark, sf_dir)
    spec = ORDER_FACTS.with_numeric(["extprice", "qty", "avg_disc"])
    out = impute(df, spec, "Median", fill_cats=False)
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in spec.numeric])


# Policy repair — extprice by forward fill, qty by linear interpolation,
# o_totalprice by mean; series = o_orderpriority ordered by (o_orderdate, o_orderkey)
POLICY = {"extprice": "Forward Fill", "qty": "Linear Interpolation", "o_totalprice": "Mean"}

_OFW = "PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey"


@query("d15_policy_repair", f"""
WITH {masked_order_facts()},
s1 AS (  -- "Forward Fill" runs first (alphabetical)
  SELECT * REPLACE (coalesce(last_value(extprice IGNORE NULLS) OVER ({_OFW}
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           (SELECT quantile_cont(extprice, 0.5) FROM mof), 0.0) AS extprice)
  FROM mof),
s2 AS (  -- then "Linear Interpolation" for qty
  SELECT *, row_number() OVER ({_OFW}) AS i FROM s1),
s3 AS (
  SELECT *,
    last_value(CASE WHEN qty IS NOT NULL THEN i END IGNORE NULLS) OVER ({_OFW}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
    last_value(qty IGNORE NULLS) OVER ({_OFW}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    first_value(CASE WHEN qty IS NOT NULL THEN i END IGNORE NULLS) OVER ({_OFW}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
    first_value(qty IGNORE NULLS) OVER ({_OFW}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM s2),
s4 AS (
  SELECT * REPLACE (coalesce(CASE WHEN qty IS NOT NULL THEN qty
            WHEN pi IS NOT NULL AND ni IS NOT NULL AND ni <> pi
              THEN pv + (nv - pv) * (i - pi) / (ni - pi)
            WHEN pi IS NOT NULL THEN pv ELSE nv END,
         (SELECT quantile_cont(qty, 0.5) FROM s1), 0.0) AS qty)
  FROM s3),
s5 AS (  -- then "Mean" for o_totalprice
  SELECT * REPLACE (coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM s4),
                             (SELECT quantile_cont(o_totalprice, 0.5) FROM s4), 0.0)
                    AS o_totalprice)
  FROM s4)
SELECT o_orderkey, round(extprice, 6) AS extprice, round(qty, 6) AS qty,
       round(o_totalprice, 6) AS o_totalprice, c_mktsegment
FROM s5""")
def d15_policy_repair(spark, sf_dir):
    df = spark_masked_order_facts(spark, sf_dir)
    out = repair_with_policy(df, ORDER_FACTS, POLICY)
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in
                                       ("extprice", "qty", "o_totalprice")], "c_mktsegment")


# ---------------------------------------------------------------- model-based
# Iterative fits and forests are not SQL-expressible; they are checked against NumPy
# brute force on fixtures in tests/test_learned.py.  Masked order_facts: the
# five numeric columns with extprice, qty, o_totalprice masked at 12 %.
LEARNED_COLS = ["o_totalprice", "qty", "extprice", "n_lines", "avg_disc"]


def _order_facts_repair(method):
    def run(spark, sf_dir):
        df = spark_masked_order_facts(spark, sf_dir)
        out = impute(df, ORDER_FACTS.with_numeric(LEARNED_COLS), method)
        return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in LEARNED_COLS])
    run.__doc__ = f"order_facts repaired by {method} (whole table)."
    return run


_WE = "PARTITION BY user_id ORDER BY ts, event_id"
_SGN = "(CASE WHEN k % 2 = 0 THEN 1.0 ELSE -1.0 END)"
_SPLINE_CTES = f"""pos AS (SELECT *, CAST(row_number() OVER ({_WE}) AS DOUBLE) AS i FROM mev),
kn AS (SELECT event_id, user_id, ts, i, value AS y,
              row_number() OVER ({_WE}) - 1 AS k,
              lead(i, 1) OVER ({_WE}) AS x1, lead(value, 1) OVER ({_WE}) AS y1
       FROM pos WHERE value IS NOT NULL),
kn2 AS (SELECT *, (y1 - y) / (x1 - i) AS s FROM kn),
f3 AS (SELECT user_id,
         max(CASE WHEN k = 0 THEN i END) AS a0, max(CASE WHEN k = 0 THEN y END) AS b0,
         max(CASE WHEN k = 1 THEN i END) AS a1, max(CASE WHEN k = 1 THEN y END) AS b1,
         max(CASE WHEN k = 2 THEN i END) AS a2, max(CASE WHEN k = 2 THEN y END) AS b2,
         count(*) AS n3
       FROM kn2 WHERE k <= 2 GROUP BY user_id),
f3b AS (SELECT user_id, CASE WHEN n3 >= 3
          THEN ((b1 - b0) / (a1 - a0) * (a2 - a0) - (b2 - b0) / (a2 - a0) * (a1 - a0)) / (a2 - a1)
          ELSE (b1 - b0) / (a1 - a0) END AS d0 FROM f3),
kn3 AS (SELECT kn2.*, f3b.d0,
          coalesce(sum({_SGN} * s) OVER ({_WE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   0.0) AS cum
        FROM kn2 LEFT JOIN f3b USING (user_id)),
kn4 AS (SELECT *, {_SGN} * (d0 - 2 * cum) AS d FROM kn3),
kn5 AS (SELECT *, ((2 * s - d) - d) / (2 * (x1 - i)) AS c FROM kn4),
pc AS (SELECT event_id,
  CASE WHEN x1 IS NULL AND lag(i, 1) OVER ({_WE}) IS NOT NULL THEN lag(i, 1) OVER ({_WE})
       ELSE i END AS px,
  CASE WHEN x1 IS NULL AND lag(i, 1) OVER ({_WE}) IS NOT NULL THEN lag(y, 1) OVER ({_WE})
       ELSE y END AS py,
  CASE WHEN x1 IS NULL AND lag(i, 1) OVER ({_WE}) IS NOT NULL THEN lag(d, 1) OVER ({_WE})
       WHEN x1 IS NULL THEN 0.0 ELSE d END AS pd,
  CASE WHEN x1 IS NULL AND lag(i, 1) OVER ({_WE}) IS NOT NULL THEN lag(c, 1) OVER ({_WE})
       WHEN x1 IS NULL THEN 0.0 ELSE c END AS pcc
  FROM kn5),
j AS (SELECT pos.*, pc.px, pc.py, pc.pd, pc.pcc FROM pos LEFT JOIN pc USING (event_id)),
j2 AS (SELECT *,
  last_value(px IGNORE NULLS) OVER ({_WE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bx,
  last_value(py IGNORE NULLS) OVER ({_WE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS by_,
  last_value(pd IGNORE NULLS) OVER ({_WE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bd,
  last_value(pcc IGNORE NULLS) OVER ({_WE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bc,
  first_value(px IGNORE NULLS) OVER ({_WE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fx,
  first_value(py IGNORE NULLS) OVER ({_WE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fy,
  first_value(pd IGNORE NULLS) OVER ({_WE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fd,
  first_value(pcc IGNORE NULLS) OVER ({_WE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fc
  FROM j),
j3 AS (SELECT *, CASE WHEN bx IS NOT NULL THEN bx ELSE fx END AS qx,
                 CASE WHEN bx IS NOT NULL THEN by_ ELSE fy END AS qy,
                 CASE WHEN bx IS NOT NULL THEN bd ELSE fd END AS qd,
                 CASE WHEN bx IS NOT NULL THEN bc ELSE fc END AS qc FROM j2)"""

query("d8_spline_interpolation", _sql("""
SELECT event_id, user_id, was_masked,
       round(coalesce(value, qy + qd * (i - qx) + qc * (i - qx) * (i - qx),
                      (SELECT m FROM med), 0.0), 6) AS value
FROM j3""", _SPLINE_CTES))(_events_repair("Spline Interpolation"))


def _knn_sql(k=5):
    """All recipient-donor distances in SQL, the k smallest of each recipient."""
    cols = LEARNED_COLS
    ctes = [masked_order_facts(), "m AS (SELECT o_orderkey, "
            + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + " FROM mof)"]
    both = {c: f"(r.{c} IS NOT NULL AND d.{c} IS NOT NULL)" for c in cols}
    square = " + ".join(f"CASE WHEN {both[c]} THEN (r.{c} - d.{c}) * (r.{c} - d.{c}) ELSE 0.0 END"
                        for c in cols)
    seen = " + ".join(f"CAST({both[c]} AS INTEGER)" for c in cols)
    for t in cols:
        ctes.append(f"""k_{t} AS (SELECT rk, CASE WHEN count(*) FILTER (WHERE dist = 0) > 0
    THEN sum(v) FILTER (WHERE dist = 0) / count(*) FILTER (WHERE dist = 0)
    ELSE sum(v / nullif(dist, 0)) / sum(1.0::DOUBLE / nullif(dist, 0)) END AS v
  FROM (SELECT rk, v, dist, row_number() OVER (PARTITION BY rk ORDER BY dist, dk) AS rn FROM (
    SELECT r.o_orderkey AS rk, d.o_orderkey AS dk, d.{t} AS v,
           sqrt(CAST({len(cols)} AS DOUBLE) / nullif({seen}, 0) * ({square})) AS dist
    FROM m r, m d WHERE r.{t} IS NULL AND d.{t} IS NOT NULL) WHERE dist IS NOT NULL)
  WHERE rn <= {k} GROUP BY rk)""")
    fills = ", ".join(f"round(coalesce(m.{c}, k_{c}.v, (SELECT avg({c}) FROM m)), 6) AS {c}"
                      for c in cols)
    joins = " ".join(f"LEFT JOIN k_{c} ON k_{c}.rk = m.o_orderkey" for c in cols)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT m.o_orderkey, {fills} FROM m {joins}"


query("d9_knn_imputer", _knn_sql())(_order_facts_repair("KNN Imputer"))
query("d10_iterative_mice")(_order_facts_repair("Iterative Imputer (MICE)"))
query("d11_regression_imputation")(_order_facts_repair("Regression Imputation"))
query("d12_random_forest_imputation")(_order_facts_repair("Random Forest Imputation"))


RIDGE_COLS = ["o_totalprice", "qty", "extprice"]


def _ridge_sql():
    """Ridge of each column on the other two, by the closed form of two scaled predictors."""
    cols = RIDGE_COLS
    ctes = [masked_order_facts(), "m AS (SELECT o_orderkey, "
            + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + " FROM mof)",
            "b AS (SELECT o_orderkey, " + ", ".join(
                f"{c} AS o_{c}, coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM m)) AS {c}" for c in cols) + " FROM m)"]
    fills = []
    for t in cols:
        x, z = (c for c in cols if c != t)
        ctes.append(f"""s_{t} AS (SELECT count(*) AS n, avg({x}) AS mx, avg({z}) AS mz, avg({t}) AS mt
  FROM b WHERE o_{t} IS NOT NULL)""")
        ctes.append(f"""g_{t} AS (SELECT any_value(n) AS n, any_value(mx) AS mx, any_value(mz) AS mz, any_value(mt) AS mt,
    sqrt(sum(({x} - mx) * ({x} - mx)) / any_value(n)) AS sx, sqrt(sum(({z} - mz) * ({z} - mz)) / any_value(n)) AS sz,
    sum(({x} - mx) * ({z} - mz)) AS xz, sum(({x} - mx) * ({t} - mt)) AS xt, sum(({z} - mz) * ({t} - mt)) AS zt
  FROM b, s_{t} WHERE o_{t} IS NOT NULL)""")
        ctes.append(f"""f_{t} AS (SELECT mx, mz, mt,
    ((n + 1) * xt / sx - xz / (sx * sz) * zt / sz) / ((n + 1) * (n + 1) - xz / (sx * sz) * xz / (sx * sz)) / sx AS cx,
    ((n + 1) * zt / sz - xz / (sx * sz) * xt / sx) / ((n + 1) * (n + 1) - xz / (sx * sz) * xz / (sx * sz)) / sz AS cz
  FROM g_{t})""")
        fills.append(f"round(coalesce(o_{t}, f_{t}.mt + f_{t}.cx * ({x} - f_{t}.mx) + f_{t}.cz * ({z} - f_{t}.mz)), 2) AS {t}")
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT o_orderkey, {', '.join(fills)} FROM b, "
            + ", ".join(f"f_{c}" for c in cols))


@query("d11_two_predictors", _ridge_sql())
def d11_two_predictors(spark, sf_dir):
    """Ridge repair of three columns, each from the other two, to cents."""
    out = impute(spark_masked_order_facts(spark, sf_dir), ORDER_FACTS.with_numeric(RIDGE_COLS),
                 "Regression Imputation")
    return out.select("o_orderkey", *[F.round(c, 2).alias(c) for c in RIDGE_COLS])
