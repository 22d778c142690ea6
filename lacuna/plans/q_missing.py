"""Missingness queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.missing import (MaskRule, benchmark_masks, inject_missingness, missing_profile,
                                 null_matrix, sample_rows)
from ..sources.tables import ORDER_FACTS_SQL, order_facts
from .catalog import query
from .fixtures_sql import MASKED_EVENTS, k_sql, masked_order_facts, md5_sql
from .panels import masked_events, masked_order_facts as spark_masked_order_facts


@query("c1_mcar_mask", f"""WITH {MASKED_EVENTS.strip()}
SELECT event_id, was_masked, round(value, 6) AS value FROM mev""")
def c1_mcar_mask(spark, sf_dir):
    return masked_events(spark, sf_dir).select("event_id", "was_masked",
                                               F.round("value", 6).alias("value"))


# Provenance rules on order_facts (mirrors the census rules: MCAR / MAR / MNAR).
def _rules():
    return [
        MaskRule("qty", "MCAR", 0.07, "Uniform random 7% mask."),
        MaskRule("extprice", "MAR", 0.10, "10% in two market segments.",
                 eligible=F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")),
        MaskRule("c_mktsegment", "MCAR", 0.04, "Uniform random 4% mask."),
        MaskRule("avg_disc", "MAR", 0.08, "8% where the segment reads FURNITURE.",
                 eligible=F.col("c_mktsegment") == "FURNITURE"),
        MaskRule("o_totalprice", "MNAR", 0.22, "22% of high order totals.", own_quantile=0.72),
    ]


def _rules_sql():
    """The same five rules, applied in order, in SQL."""
    of = f"of AS ({ORDER_FACTS_SQL})"
    s1 = f"""s1 AS (SELECT * REPLACE (CASE WHEN r <= {k_sql('n', 0.07)} THEN NULL ELSE qty END AS qty),
                  r <= {k_sql('n', 0.07)} AS m1
  FROM (SELECT *, row_number() OVER (ORDER BY {md5_sql(['o_orderkey'], 'qty')}) AS r,
               count(*) OVER () AS n FROM of))"""
    s2 = f"""s2 AS (SELECT * EXCLUDE (r, n, e) REPLACE (CASE WHEN e AND r <= {k_sql('n', 0.10)}
                  THEN NULL ELSE extprice END AS extprice), e AND r <= {k_sql('n', 0.10)} AS m2
  FROM (SELECT *, coalesce(c_mktsegment IN ('AUTOMOBILE', 'BUILDING'), false) AS e,
               row_number() OVER (PARTITION BY coalesce(c_mktsegment IN ('AUTOMOBILE',
                 'BUILDING'), false) ORDER BY {md5_sql(['o_orderkey'], 'extprice')}) AS r,
               count(*) FILTER (WHERE coalesce(c_mktsegment IN ('AUTOMOBILE', 'BUILDING'),
                 false)) OVER () AS n
        FROM (SELECT * EXCLUDE (r, n) FROM s1)))"""
    s3 = f"""s3 AS (SELECT * EXCLUDE (r, n) REPLACE (CASE WHEN r <= {k_sql('n', 0.04)} THEN NULL
                  ELSE c_mktsegment END AS c_mktsegment), r <= {k_sql('n', 0.04)} AS m3
  FROM (SELECT *, row_number() OVER (ORDER BY {md5_sql(['o_orderkey'], 'c_mktsegment')}) AS r,
               count(*) OVER () AS n FROM s2))"""
    s4 = f"""s4 AS (SELECT * EXCLUDE (r, n, e) REPLACE (CASE WHEN e AND r <= {k_sql('n', 0.08)}
                  THEN NULL ELSE avg_disc END AS avg_disc), e AND r <= {k_sql('n', 0.08)} AS m4
  FROM (SELECT *, coalesce(c_mktsegment = 'FURNITURE', false) AS e,
               row_number() OVER (PARTITION BY coalesce(c_mktsegment = 'FURNITURE', false)
                 ORDER BY {md5_sql(['o_orderkey'], 'avg_disc')}) AS r,
               count(*) FILTER (WHERE coalesce(c_mktsegment = 'FURNITURE', false)) OVER () AS n
        FROM s3))"""
    s5 = f"""s5 AS (SELECT * EXCLUDE (r, n, e) REPLACE (CASE WHEN e AND r <= {k_sql('n', 0.22)}
                  THEN NULL ELSE o_totalprice END AS o_totalprice),
                  e AND r <= {k_sql('n', 0.22)} AS m5
  FROM (SELECT *, coalesce(o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.72) FROM of),
                           false) AS e,
               row_number() OVER (PARTITION BY coalesce(o_totalprice >=
                 (SELECT quantile_cont(o_totalprice, 0.72) FROM of), false)
                 ORDER BY {md5_sql(['o_orderkey'], 'o_totalprice')}) AS r,
               count(*) FILTER (WHERE coalesce(o_totalprice >=
                 (SELECT quantile_cont(o_totalprice, 0.72) FROM of), false)) OVER () AS n
        FROM s4))"""
    return ",\n".join([of, s1, s2, s3, s4, s5])


def _masked_by_rules(spark, sf_dir):
    return inject_missingness(order_facts(spark, sf_dir), ["o_orderkey"], _rules())


@query("c2_c3_rule_masks", f"""WITH {_rules_sql()}
SELECT o_orderkey, round(qty, 6) AS qty, round(extprice, 6) AS extprice, c_mktsegment,
       round(avg_disc, 6) AS avg_disc, round(o_totalprice, 6) AS o_totalprice
FROM s5""")
def c2_c3_rule_masks(spark, sf_dir):
    """MCAR, MAR (eligibility reads earlier masks) and MNAR (own-quantile) masks in order."""
    masked, _ = _masked_by_rules(spark, sf_dir)
    return masked.select("o_orderkey", F.round("qty", 6).alias("qty"),
                         F.round("extprice", 6).alias("extprice"), "c_mktsegment",
                         F.round("avg_disc", 6).alias("avg_disc"),
                         F.round("o_totalprice", 6).alias("o_totalprice"))


@query("c4_mask_provenance", f"""WITH {_rules_sql()}
SELECT meta.column_name, meta.mechanism, CAST(meta.rate AS DOUBLE) * 100 AS target_missing_percentage,
       CAST(cnt.realized_missing_rows AS BIGINT) AS realized_missing_rows, meta.rule
FROM (VALUES
  ('qty', 'MCAR', 0.07, 'Uniform random 7% mask.'),
  ('extprice', 'MAR', 0.10, '10% in two market segments.'),
  ('c_mktsegment', 'MCAR', 0.04, 'Uniform random 4% mask.'),
  ('avg_disc', 'MAR', 0.08, '8% where the segment reads FURNITURE.'),
  ('o_totalprice', 'MNAR', 0.22, '22% of high order totals.')) AS meta(column_name, mechanism,
    rate, rule)
JOIN (SELECT 'qty' AS c, CAST(count_if(m1) AS BIGINT) AS realized_missing_rows FROM s5
      UNION ALL SELECT 'extprice', count_if(m2) FROM s5
      UNION ALL SELECT 'c_mktsegment', count_if(m3) FROM s5
      UNION ALL SELECT 'avg_disc', count_if(m4) FROM s5
      UNION ALL SELECT 'o_totalprice', count_if(m5) FROM s5) cnt ON cnt.c = meta.column_name""")
def c4_mask_provenance(spark, sf_dir):
    _, prov = _masked_by_rules(spark, sf_dir)
    return prov


_PROFILE_COLS = ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
                 "c_mktsegment", "o_totalprice", "n_lines", "qty", "extprice", "avg_disc"]


def _profile_sql():
    parts = []
    for c in _PROFILE_COLS:
        parts.append(f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_count, "
                     f"count_if({c} IS NULL) / count(*) AS missing_rate, "
                     f"count_if({c} IS NULL) * 100.0 / count(*) AS missing_pct FROM mof")
    return f"WITH {masked_order_facts()}\n" + "\nUNION ALL\n".join(parts)


@query("c6_c7_missing_profile", _profile_sql())
def c6_c7_missing_profile(spark, sf_dir):
    """Missing count, rate and percent per column (sort by rate descending at the sink)."""
    df = spark_masked_order_facts(spark, sf_dir).select(*_PROFILE_COLS)
    return missing_profile(df)


@query("c8_null_matrix", f"""WITH {masked_order_facts()},
pick AS (SELECT * FROM mof ORDER BY {md5_sql(['o_orderkey'], 'nullmatrix')} LIMIT 400)
SELECT o_orderkey, c AS column_name, isn AS is_null FROM (
  SELECT o_orderkey, 'qty' AS c, qty IS NULL AS isn FROM pick
  UNION ALL SELECT o_orderkey, 'extprice', extprice IS NULL FROM pick
  UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice IS NULL FROM pick
  UNION ALL SELECT o_orderkey, 'n_lines', n_lines IS NULL FROM pick)""")
def c8_null_matrix(spark, sf_dir):
    df = spark_masked_order_facts(spark, sf_dir)
    return null_matrix(df, ["o_orderkey"], ["qty", "extprice", "o_totalprice", "n_lines"])


_BENCH_COLS = ["o_totalprice", "n_lines", "qty", "extprice", "avg_disc"]


def _bench_masks_sql():
    longs = " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM of "
        f"WHERE {c} IS NOT NULL" for c in _BENCH_COLS)
    return f"""WITH of AS ({ORDER_FACTS_SQL}),
lg AS ({longs}),
rk AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY
          {md5_sql(['o_orderkey', 'feature'])}) AS r,
          count(*) OVER (PARTITION BY feature) AS n FROM lg)
SELECT o_orderkey, feature, round(value, 6) AS value, r <= {k_sql('n', 0.12)} AS masked
FROM rk WHERE n >= 2"""


@query("c9_benchmark_masks", _bench_masks_sql())
def c9_benchmark_masks(spark, sf_dir):
    m = benchmark_masks(order_facts(spark, sf_dir), ["o_orderkey"], _BENCH_COLS)
    return m.select("o_orderkey", "feature", F.round("value", 6).alias("value"), "masked")


@query("c10_benchmark_sample", f"""
SELECT event_id, user_id, round(value, 6) AS value FROM events
ORDER BY {md5_sql(['event_id'], 'sample')} LIMIT 1600""")
def c10_benchmark_sample(spark, sf_dir):
    from ..sources.tables import events_series
    s = sample_rows(events_series(spark, sf_dir), ["event_id"], 1600)
    return s.select("event_id", "user_id", F.round("value", 6).alias("value"))
