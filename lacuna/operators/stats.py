"""Statistical tests from distributed aggregates.

Every statistic is a Spark aggregate (sums, counts, moments, correlations,
average ranks from ``rank``); only the final scalar -> p-value step runs on
the driver (``functions.pvalues``).  Results are rows of
(test, comparison, statistic, p_value, effect_size).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pvalues as pv
from ..functions.exprs import DEFAULT_SEED, finite_or_null
from .missing import sample_rows
from .rank import average_ranks, positions, tie_counts

RESULT_SCHEMA = "test string, comparison string, statistic double, p_value double, effect_size double"


def _num(c):
    return finite_or_null(F.col(c).cast("double"))


def _result(spark, rows):
    return spark.createDataFrame(rows, RESULT_SCHEMA)


# ------------------------------------------------------------------ correlations
def pearson(df: DataFrame, cols, target: str):
    """H5 per column vs target: (column, n, r); skip n < 3 or a constant side."""
    aggs = []
    for i, c in enumerate(cols):
        both = _num(c).isNotNull() & _num(target).isNotNull()
        aggs += [F.corr(_num(c), _num(target)).alias(f"r{i}"), F.count_if(both).alias(f"n{i}"),
                 F.stddev_pop(F.when(both, _num(c))).alias(f"sx{i}"),
                 F.stddev_pop(F.when(both, _num(target))).alias(f"sy{i}")]
    row = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(cols):
        n, r = row[f"n{i}"], row[f"r{i}"]
        if n < 3 or not row[f"sx{i}"] or not row[f"sy{i}"] or r is None:
            continue
        out.append((c, n, r))
    return out


def _r_pvalue(r: float, n: int) -> float:
    if abs(r) >= 1.0:
        return 0.0
    t = r * math.sqrt((n - 2) / (1.0 - r * r))
    return pv.t_sf2(t, n - 2)


def correlation_tests(df: DataFrame, cols, target: str, spearman: bool = True) -> DataFrame:
    """Pearson and Spearman rows for each column vs the target."""
    spark = df.sparkSession
    rows = []
    for c, n, r in pearson(df, cols, target):
        rows.append(("Pearson Correlation", f"{c} vs {target}", r, _r_pvalue(r, n), r * r))
    if spearman:
        for c, n, rho in spearman_rho(df, cols, target):
            rows.append(("Spearman Correlation", f"{c} vs {target}", rho, _r_pvalue(rho, n),
                         rho * rho))
    return _result(spark, rows)


def spearman_rho(df: DataFrame, cols, target: str):
    """H6: Pearson r of average ranks, per pair over its complete rows.

    Each column is ranked over the rows where both sides are known, and the target once for
    all columns that are known in the same rows.
    """
    from ..session import cut_lineage
    cols = list(cols)
    x = [f"x{i}" for i in range(len(cols))]
    wide = df.select(_num(target).alias("y"), *[_num(c).alias(n) for c, n in zip(cols, x)])
    wide = cut_lineage(wide.filter(F.col("y").isNotNull() & F.coalesce(F.lit(None).cast("double"), *x).isNotNull()))
    pairs = [(i, j) for j in range(len(x)) for i in range(j)]
    apart = wide.agg(F.count(F.lit(1)), *[F.count_if(F.col(x[i]).isNull() != F.col(x[j]).isNull())
                                          for i, j in pairs]).first()[1:]
    alike = {p for p, n in zip(pairs, apart) if n == 0}
    first = [next((i for i in range(j) if (i, j) in alike), j) for j in range(len(x))]
    ranked = wide.select(*x, *[F.when(F.col(x[i]).isNotNull(), F.col("y")).alias(f"y{i}") for i in sorted(set(first))])
    for n in list(ranked.columns):
        ranked = average_ranks(ranked, [], n, f"r_{n}")
    got = ranked.agg(*[e for n, i in zip(x, first) for e in (
        F.corr(f"r_{n}", f"r_y{i}").alias(f"rho_{n}"), F.count(n).alias(f"n_{n}"),
        F.stddev_pop(n).alias(f"sx_{n}"), F.stddev_pop(F.when(F.col(n).isNotNull(), F.col(f"y{i}"))).alias(f"sy_{n}"))
    ]).first()
    out = []
    for c, n in zip(cols, x):
        r = {k: got[f"{k}_{n}"] for k in ("rho", "n", "sx", "sy")}
        if r["n"] < 3 or not r["sx"] or not r["sy"] or r["rho"] is None:
            continue
        out.append((c, r["n"], r["rho"]))
    return out


# ------------------------------------------------------------------ group tests
def anova(df: DataFrame, value: str, group: str, label: str | None = None) -> DataFrame:
    """H7: one-way ANOVA over groups with >= 2 values; F, p and eta squared."""
    spark = df.sparkSession
    x = _num(value)
    g = df.filter(x.isNotNull()).groupBy(group).agg(
        F.count(x).alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v"))
    g = g.filter(F.col("n") >= 2)
    tot = g.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
                (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm")).first()
    comparison = label or f"{value} across {group}"
    if tot["k"] is None or tot["k"] < 2:
        return _result(spark, [])
    s = g.agg(F.sum(F.col("n") * (F.col("m") - F.lit(tot["gm"])) ** 2).alias("ssb"),
              F.sum(F.col("n") * F.col("v")).alias("ssw")).first()
    k, n = tot["k"], tot["N"]
    ssb, ssw = s["ssb"], s["ssw"]
    f = (ssb / (k - 1)) / (ssw / (n - k)) if ssw > 0 else float("inf")
    eta = ssb / (ssb + ssw) if (ssb + ssw) > 0 else 0.0
    return _result(spark, [("ANOVA", comparison, f, pv.f_sf(f, k - 1, n - k), eta)])


def two_group_moments(df: DataFrame, value: str, flag) -> dict:
    x = _num(value)
    fl = flag if not isinstance(flag, str) else F.col(flag)
    base = df.filter(x.isNotNull())
    r = base.agg(
        F.count_if(fl).alias("n1"), F.avg(F.when(fl, x)).alias("m1"),
        F.var_samp(F.when(fl, x)).alias("v1"),
        F.count_if(~fl).alias("n2"), F.avg(F.when(~fl, x)).alias("m2"),
        F.var_samp(F.when(~fl, x)).alias("v2")).first()
    return r.asDict()


def welch_t(mo: dict):
    n1, n2, m1, m2, v1, v2 = (mo[k] for k in ("n1", "n2", "m1", "m2", "v1", "v2"))
    se2 = v1 / n1 + v2 / n2
    t = (m1 - m2) / math.sqrt(se2) if se2 > 0 else float("nan")
    dfw = se2 ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1)) if se2 > 0 else float("nan")
    pooled = math.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))
    d = (m1 - m2) / pooled if pooled > 0 else 0.0
    return t, pv.t_sf2(t, dfw) if not math.isnan(t) else float("nan"), d


def mann_whitney(df: DataFrame, value: str, flag: str):
    """H9: U of group 1 from average ranks; tie- and continuity-corrected normal p."""
    x = _num(value)
    base = df.select(x.alias("x"), F.col(flag).alias("g")).filter(F.col("x").isNotNull())
    base = base.withColumn("_all", F.lit(1))
    ranked = average_ranks(base, ["_all"], "x", "rk")
    r = ranked.agg(F.sum(F.when(F.col("g"), F.col("rk"))).alias("r1"),
                   F.count_if(F.col("g")).alias("n1"), F.count_if(~F.col("g")).alias("n2")).first()
    ties = tie_counts(base, ["_all"], "x").first()["tie_term"] or 0.0
    n1, n2 = r["n1"], r["n2"]
    u1 = r["r1"] - n1 * (n1 + 1) / 2.0
    n = n1 + n2
    mu = n1 * n2 / 2.0
    sd = math.sqrt(n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1))))
    u = max(u1, n1 * n2 - u1)
    z = (u - mu - 0.5) / sd if sd > 0 else float("nan")
    p = min(1.0, 2.0 * pv.norm_sf(z)) if sd > 0 else float("nan")
    return u1, p, 1.0 - 2.0 * u1 / (n1 * n2)


def two_group_tests(df: DataFrame, value: str, flag: str, label: str) -> DataFrame:
    """H8 + H9: Welch t-test with Cohen's d (pooled sd), Mann-Whitney U with rank-biserial."""
    spark = df.sparkSession
    mo = two_group_moments(df, value, flag)
    if (mo["n1"] or 0) < 2 or (mo["n2"] or 0) < 2:
        return _result(spark, [])
    t, p, d = welch_t(mo)
    u, pu, rb = mann_whitney(df, value, flag)
    return _result(spark, [("Independent t-test", label, t, p, d),
                           ("Mann-Whitney U", label, u, pu, rb)])


# ------------------------------------------------------------------ categorical
def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed counts per (a, b), long form (zero cells are absent)."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(
        F.count(F.lit(1)).alias("count"))


def chi_square(df: DataFrame, a: str, b: str, label: str | None = None) -> DataFrame:
    """Chi-square of independence and Cramer's V, without enumerating zero cells.

    sum over all cells (O-E)^2/E = sum over observed cells (O-E)^2/E + (N - sum of
    their E), because E sums to N over all cells and O = 0 elsewhere.  Only the
    2x2 case (Yates correction) needs all four cells, computed from four counts.
    """
    spark = df.sparkSession
    ct = crosstab_long(df, a, b)
    ra = ct.groupBy(a).agg(F.sum("count").alias("ra"))
    cb = ct.groupBy(b).agg(F.sum("count").alias("cb"))
    tot = ct.agg(F.sum("count").alias("N")).first()["N"] or 0
    r_n = ra.count()
    c_n = cb.count()
    comparison = label or f"{a} vs {b}"
    if r_n < 2 or c_n < 2:
        return _result(spark, [])
    e = (F.col("ra") * F.col("cb") / F.lit(float(tot)))
    cells = ct.join(ra, a).join(cb, b).withColumn("E", e)
    dof = (r_n - 1) * (c_n - 1)
    if dof == 1:
        obs = {(r[a], r[b]): r["count"] for r in ct.collect()}          # <= 4 cells
        rows = {r[a]: r["ra"] for r in ra.collect()}
        cols = {r[b]: r["cb"] for r in cb.collect()}
        stat = 0.0
        for ka, va in rows.items():
            for kb, vb in cols.items():
                ex = va * vb / tot
                o = obs.get((ka, kb), 0)
                dev = abs(o - ex) - min(0.5, abs(o - ex))
                stat += dev * dev / ex
    else:
        s = cells.agg(F.sum((F.col("count") - F.col("E")) ** 2 / F.col("E")).alias("s"),
                      F.sum("E").alias("se")).first()
        stat = s["s"] + (tot - s["se"])
    v = math.sqrt(stat / (tot * min(r_n - 1, c_n - 1))) if tot > 0 else float("nan")
    return _result(spark, [("Chi-Square", comparison, stat, pv.chi2_sf(stat, dof), v)])


# ------------------------------------------------------------------ normality
def normality_tests(df: DataFrame, value: str, key_cols, n_max: int = 5000,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """H1-H4: normality of a column after standardising it.

    Kolmogorov-Smirnov D and Anderson-Darling A^2 use every value, from counts of
    distinct values and their running counts (a tie of c values after b smaller ones
    has the ranks b+1 ... b+c, whose odd numbers sum to (b+c)^2 - b^2).  Shapiro-Wilk
    is defined for samples: W = (sum a_i x_(i))^2 / SS with Royston's weights on an exact md5
    sample of at most ``n_max`` values, a parameter of the test.
    """
    from ..functions.udfs import normal_cdf as phi
    from ..session import cut_lineage
    from .rank import running_counts

    spark = df.sparkSession
    base = df.select(*key_cols, _num(value).alias("x")).filter(F.col("x").isNotNull())
    mom = base.agg(F.count("x").alias("n"), F.avg("x").alias("m"),
                   F.stddev_samp("x").alias("sd")).first()
    n, mean, sd = mom["n"], mom["m"], mom["sd"]
    rows = []
    if n < 3:
        return _result(spark, rows)
    label = f"Normality of {value}"
    w, m = shapiro_wilk(cut_lineage(sample_rows(base, key_cols, n_max, seed, salt="normality")),
                        key_cols)
    rows.append(("Shapiro-Wilk", label, w, pv.shapiro_p(w, m), None))
    if sd and sd > 0:
        z = (running_counts(base.withColumn("_all", F.lit(1)), ["_all"], "x")
             .withColumn("z", (F.col("x") - F.lit(mean)) / F.lit(sd))
             .select(F.col("_before").cast("double").alias("b"),
                     F.col("_count").cast("double").alias("c"),
                     phi("z").alias("cdf"), phi(-F.col("z")).alias("sf")))
        upto, size = F.col("b") + F.col("c"), F.lit(float(n))
        low = upto * upto - F.col("b") * F.col("b")
        high = (size - F.col("b")) ** 2 - (size - upto) ** 2
        r = z.agg(F.max(F.greatest(upto / size - F.col("cdf"), F.col("cdf") - F.col("b") / size))
                  .alias("d"),
                  F.sum(low * F.log("cdf") + high * F.log("sf")).alias("s")).first()
        rows.append(("Kolmogorov-Smirnov", label, r["d"], pv.kolmogorov_sf(r["d"], n), None))
        rows.append(("Anderson-Darling", label, -n - r["s"] / n, None, None))
    return _result(spark, rows)


def shapiro_wilk(sample: DataFrame, key_cols) -> tuple[float, int]:
    """W and the number of values of a materialised sample ``key_cols, x``."""
    mom = sample.agg(F.count("x").alias("n"), F.avg("x").alias("m")).first()
    n, mean = mom["n"], mom["m"]
    pos = positions(sample.withColumn("_all", F.lit(1)), ["_all"], ["x", *key_cols], "i")
    coef = sample.sparkSession.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(pv.shapiro_coefficients(n))], "i long, a double")
    got = pos.join(F.broadcast(coef), "i").agg(
        F.sum((F.col("x") - F.lit(mean)) ** 2).alias("ss"),
        F.sum(F.col("a") * F.col("x")).alias("b")).first()
    return (min(1.0, got["b"] ** 2 / got["ss"]) if got["ss"] and got["ss"] > 0 else float("nan")), n
