"""Statistical-test queries (H1-H11) on the whole order_facts panel.

SQL-checked queries return (test, comparison, statistic, effect_size); DuckDB
has no t / F / chi-square tails, so p-values are in ``h_statistical_results``
(rows-only check; the tails are unit-tested against known values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import truthy
from ..operators import stats
from ..sources.tables import ORDER_FACTS_SQL, order_facts
from .catalog import query

TARGET = "o_totalprice"
CANDIDATES = ["qty", "extprice", "n_lines", "avg_disc"]
OF = f"WITH of AS ({ORDER_FACTS_SQL})"


def _panel(spark, sf_dir) -> DataFrame:
    """order_facts with a weekend flag (truthy-normalised day-of-week indicator)."""
    df = order_facts(spark, sf_dir)
    wk = F.weekday(F.to_date("o_orderdate")).isin(5, 6).cast("int")
    return df.withColumn("weekend", truthy(wk, "numeric"))


def _no_p(df: DataFrame) -> DataFrame:
    return df.select("test", "comparison", F.round("statistic", 6).alias("statistic"),
                     F.round("effect_size", 6).alias("effect_size"))


@query("h5_pearson", OF + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'Pearson Correlation' AS test, '{c} vs {TARGET}' AS comparison, "
    f"round(corr({c}, {TARGET}), 6) AS statistic, "
    f"round(corr({c}, {TARGET}) * corr({c}, {TARGET}), 6) AS effect_size FROM of"
    for c in CANDIDATES))
def h5_pearson(spark, sf_dir):
    return _no_p(stats.correlation_tests(_panel(spark, sf_dir), CANDIDATES, TARGET,
                                         spearman=False))


def _spearman_sql():
    parts = []
    for c in CANDIDATES:
        parts.append(f"""SELECT '{c}' AS pair, {c} AS x, {TARGET} AS y FROM of
                         WHERE {c} IS NOT NULL AND {TARGET} IS NOT NULL""")
    longs = " UNION ALL ".join(parts)
    return f"""{OF},
lg AS ({longs}),
rk AS (SELECT pair,
  rank() OVER (PARTITION BY pair ORDER BY x) + (count(*) OVER (PARTITION BY pair, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY pair ORDER BY y) + (count(*) OVER (PARTITION BY pair, y) - 1) / 2.0 AS ry
  FROM lg)
SELECT 'Spearman Correlation' AS test, pair || ' vs {TARGET}' AS comparison,
       round(corr(rx, ry), 6) AS statistic, round(corr(rx, ry) * corr(rx, ry), 6) AS effect_size
FROM rk GROUP BY pair"""


@query("h6_spearman", _spearman_sql())
def h6_spearman(spark, sf_dir):
    spark_ = spark
    rows = [("Spearman Correlation", f"{c} vs {TARGET}", rho, None, rho * rho)
            for c, n, rho in stats.spearman_rho(_panel(spark, sf_dir), CANDIDATES, TARGET)]
    return _no_p(spark_.createDataFrame(rows, stats.RESULT_SCHEMA))


@query("h7_anova", OF + f""",
g AS (SELECT o_orderpriority, count({TARGET}) AS n, avg({TARGET}) AS m,
             var_pop({TARGET}) AS v FROM of WHERE {TARGET} IS NOT NULL
      GROUP BY o_orderpriority HAVING count({TARGET}) >= 2),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS gm FROM g),
s AS (SELECT sum(n * (m - gm) * (m - gm)) AS ssb, sum(n * v) AS ssw FROM g, t)
SELECT 'ANOVA' AS test, '{TARGET} across o_orderpriority' AS comparison,
       round((ssb / (k - 1)) / (ssw / (nn - k)), 6) AS statistic,
       round(ssb / (ssb + ssw), 6) AS effect_size
FROM s, t""")
def h7_anova(spark, sf_dir):
    return _no_p(stats.anova(_panel(spark, sf_dir), TARGET, "o_orderpriority"))


_FLAG_SQL = "isodow(o_orderdate) - 1 IN (5, 6)"
_LABEL = "Weekend vs Weekday"


@query("h8_welch_t", OF + f""",
m AS (SELECT count_if({_FLAG_SQL}) AS n1, avg(CASE WHEN {_FLAG_SQL} THEN {TARGET} END) AS m1,
             var_samp(CASE WHEN {_FLAG_SQL} THEN {TARGET} END) AS v1,
             count_if(NOT ({_FLAG_SQL})) AS n2,
             avg(CASE WHEN NOT ({_FLAG_SQL}) THEN {TARGET} END) AS m2,
             var_samp(CASE WHEN NOT ({_FLAG_SQL}) THEN {TARGET} END) AS v2
      FROM of WHERE {TARGET} IS NOT NULL)
SELECT 'Independent t-test' AS test, '{_LABEL}' AS comparison,
       round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS statistic,
       round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 6) AS effect_size
FROM m""")
def h8_welch_t(spark, sf_dir):
    res = stats.two_group_tests(_panel(spark, sf_dir), TARGET, "weekend", _LABEL)
    return _no_p(res.filter(F.col("test") == "Independent t-test"))


@query("h9_mann_whitney", OF + f""",
b AS (SELECT {TARGET} AS x, {_FLAG_SQL} AS g FROM of WHERE {TARGET} IS NOT NULL),
r AS (SELECT g, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM b),
s AS (SELECT sum(CASE WHEN g THEN rk END) AS r1, count_if(g) AS n1, count_if(NOT g) AS n2 FROM r)
SELECT 'Mann-Whitney U' AS test, '{_LABEL}' AS comparison,
       round(r1 - n1 * (n1 + 1) / 2.0, 6) AS statistic,
       round(1.0 - 2.0 * (r1 - n1 * (n1 + 1) / 2.0) / (n1 * n2), 6) AS effect_size
FROM s""")
def h9_mann_whitney(spark, sf_dir):
    u, _p, rb = stats.mann_whitney(_panel(spark, sf_dir), TARGET, "weekend")
    rows = [("Mann-Whitney U", _LABEL, u, None, rb)]
    return _no_p(spark.createDataFrame(rows, stats.RESULT_SCHEMA))


@query("h10_chi_square", OF + """,
ct AS (SELECT c_mktsegment AS a, o_orderstatus AS b, count(*) AS o FROM of
       WHERE c_mktsegment IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS ra FROM ct GROUP BY a),
cb AS (SELECT b, sum(o) AS cb FROM ct GROUP BY b),
tot AS (SELECT sum(o) AS n FROM ct),
cells AS (SELECT ra.a, cb.b, coalesce(ct.o, 0) AS o, ra.ra * cb.cb / tot.n AS e
          FROM ra CROSS JOIN cb CROSS JOIN tot LEFT JOIN ct ON ct.a = ra.a AND ct.b = cb.b),
st AS (SELECT sum((o - e) * (o - e) / e) AS chi FROM cells)
SELECT 'Chi-Square' AS test, 'c_mktsegment vs o_orderstatus' AS comparison,
       round(chi, 6) AS statistic,
       round(sqrt(chi / ((SELECT n FROM tot) * least((SELECT count(*) FROM ra) - 1,
                                                    (SELECT count(*) FROM cb) - 1))), 6)
         AS effect_size
FROM st""")
def h10_chi_square(spark, sf_dir):
    return _no_p(stats.chi_square(_panel(spark, sf_dir), "c_mktsegment", "o_orderstatus"))


@query("h11_crosstab", OF + """
SELECT c_mktsegment, o_orderstatus, CAST(count(*) AS BIGINT) AS count FROM of
WHERE c_mktsegment IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2""")
def h11_crosstab(spark, sf_dir):
    return stats.crosstab_long(_panel(spark, sf_dir), "c_mktsegment", "o_orderstatus")


@query("h_statistical_results")
def h_statistical_results(spark, sf_dir):
    """The full results table with p-values: normality, correlations, ANOVA,
    two-group tests and chi-square (the reference's ``analyze`` output)."""
    df = _panel(spark, sf_dir)
    parts = [
        stats.normality_tests(df, TARGET, ["o_orderkey"]),
        stats.correlation_tests(df, CANDIDATES, TARGET),
        stats.anova(df, TARGET, "o_orderpriority"),
        stats.two_group_tests(df, TARGET, "weekend", _LABEL),
        stats.chi_square(df, "c_mktsegment", "o_orderstatus"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
