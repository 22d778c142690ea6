"""Exact selection, quantiles and distributed ranks against pandas / NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lacuna.functions.exprs import md5_key
from lacuna.operators import quantile, rank, select


def test_hash_thresholds_exact_multilevel(spark):
    df = spark.range(0, 5000).withColumn("h", md5_key(["id"], 7))
    hs = sorted(r["h"] for r in df.collect())
    for k in (1, 17, 600, 4999, 5000):
        # tiny leaf forces prefix refinement through several levels
        th = select.hash_thresholds(df, "h", {"__all__": k}, {"__all__": 5000}, leaf_rows=50)
        assert th["__all__"] == hs[k - 1]
        n = df.filter(select.smallest_flag("h", th)).count()
        assert n == k


def test_hash_thresholds_grouped(spark):
    df = spark.range(0, 3000).withColumn("g", (F.col("id") % 3).cast("string")) \
        .withColumn("h", md5_key(["id"], 1))
    counts = {"0": 1000, "1": 1000, "2": 1000}
    ks = {"0": 5, "1": 120, "2": 999}
    th = select.hash_thresholds(df, "h", ks, counts, group_col="g", leaf_rows=40)
    got = df.filter(select.smallest_flag("h", th, "g")).groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in got} == ks


def test_mask_count_rule():
    assert select.mask_count(10000, 0.12) == 1200
    assert select.mask_count(3, 0.12) == 1
    assert select.mask_count(0, 0.5) == 0


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=4000), np.full(500, 2.5), [np.nan] * 10])
    pdf = pd.DataFrame({"x": vals, "y": rng.integers(0, 5, size=len(vals)).astype(float)})
    df = spark.createDataFrame(pdf).select(
        F.when(F.isnan("x"), None).otherwise(F.col("x")).alias("x"), "y")
    probs = [0.0, 0.1, 0.25, 0.5, 0.72, 0.75, 1.0]
    q = quantile.exact_quantiles(df, ["x", "y"], probs, leaf_rows=100)
    xs = vals[~np.isnan(vals)]
    for p in probs:
        assert abs(q[("x", p)] - np.quantile(xs, p)) < 1e-12
        assert abs(q[("y", p)] - np.quantile(pdf["y"], p)) < 1e-12


def test_exact_quantiles_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantile.exact_quantiles(df, ["x"], [0.5])[("x", 0.5)] is None


def test_positions_and_average_ranks(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "v": rng.integers(0, 50, 3000).astype(float),
                        "id": np.arange(3000)})
    df = spark.createDataFrame(pdf)
    pos = rank.positions(df, ["g"], ["v", "id"], "pos", num_partitions=7).toPandas()
    exp = pdf.sort_values(["g", "v", "id"]).groupby("g").cumcount() + 1
    got = pos.set_index("id")["pos"].sort_index()
    assert (got.to_numpy() == exp.sort_index().to_numpy()).all()
    ar = rank.average_ranks(df, ["g"], "v", "rk", num_partitions=5).toPandas().set_index("id")
    expr = pdf.groupby("g")["v"].rank(method="average")
    assert np.allclose(ar["rk"].sort_index().to_numpy(), expr.sort_index().to_numpy())


def test_running_totals(spark):
    pdf = pd.DataFrame({"s": np.arange(200, dtype=float), "a": np.ones(200), "b": np.arange(200.0)})
    out = rank.running_totals(spark.createDataFrame(pdf), "s", ["a", "b"], descending=True,
                              num_partitions=6).toPandas().sort_values("s", ascending=False)
    assert np.allclose(out["cum_a"], np.arange(1, 201))
    assert np.allclose(out["cum_b"], np.cumsum(pdf["b"][::-1].to_numpy()))


def test_exact_quantiles_bracket_without_sketches(spark, monkeypatch):
    """A sketch of every value was the cost of each pass; ties, infinities and NaN stay exact."""
    from lacuna.operators.quantile import exact_quantiles

    def sketch(*_):
        raise AssertionError("a sketch over all rows")

    monkeypatch.setattr(F, "percentile_approx", sketch)
    rng = np.random.default_rng(3)
    n = 30_000
    heavy = rng.integers(0, 3, n).astype(float)
    wide = rng.standard_cauchy(n) * 1e6
    wide[:40], wide[40:90] = np.inf, -np.inf
    rows = [(float(a), None if i % 7 == 0 else float(b), float("nan") if i % 5 == 0 else 1.0)
            for i, (a, b) in enumerate(zip(heavy, wide))]
    df = spark.createDataFrame(rows, "heavy double, wide double, nan double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["heavy", "wide", "nan"], probs, leaf_rows=50)
    known = np.array([r[1] for r in rows if r[1] is not None])
    for p in probs:
        assert got["heavy", p] == np.quantile(heavy, p)
        at = np.sort(known)[int(np.floor((len(known) - 1) * p))]
        assert got["wide", p] == pytest.approx(np.quantile(known, p)) if np.isfinite(at) else got["wide", p] == at
        assert np.isnan(got["nan", p]) if p > 0.8 else got["nan", p] == 1.0


def test_spearman_ranks_a_shared_target_once(spark, monkeypatch):
    from lacuna.operators import stats
    rng = np.random.default_rng(8)
    a, b, c, y = (rng.integers(0, m, 300).astype(float).tolist() for m in (5, 40, 200, 60))
    rows = [(None if i % 7 == 0 else p, None if i % 7 == 0 else q, None if i % 5 == 0 else r, None if i % 11 == 0 else t)
            for i, (p, q, r, t) in enumerate(zip(a, b, c, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    ranked, real = [], stats.average_ranks
    monkeypatch.setattr(stats, "average_ranks", lambda df, *k: ranked.append(df.count()) or real(df, *k))
    got = {n: (k, r) for n, k, r in stats.spearman_rho(df, ["a", "b", "c"], "y")}
    assert len(ranked) == 5 and max(ranked) <= 300  # a, b and c; y for a and b, y for c: never stacked

    def mid(v):
        return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])

    for k, n in enumerate("abc"):
        v = np.array([(r[k], r[3]) for r in rows if r[k] is not None and r[3] is not None])
        assert got[n][0] == len(v)
        assert abs(got[n][1] - np.corrcoef(mid(v[:, 0]), mid(v[:, 1]))[0, 1]) < 1e-12
