"""Primitives on ties, NULL group keys and repeated keys; leaks and size switches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.functions.erf import erfc
from lacuna.functions.exprs import md5_key
from lacuna.operators import features, modeling, outliers, quantile, rank, select, series, stats
from lacuna.operators.impute import impute
from lacuna.operators.learned import impute_mice
from lacuna.spec import PanelSpec


def test_tied_quantiles_collect_no_tie(spark, monkeypatch):
    df = spark.range(20_000).select((F.col("id") % 3).cast("double").alias("x"))
    sizes = []
    frame = type(df)
    collect = frame.collect

    def counted(self):
        rows = collect(self)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(frame, "collect", counted)
    q = quantile.exact_quantiles(df, ["x"], [0.0, 0.2, 0.5, 0.9, 1.0], leaf_rows=100)
    assert [q[("x", p)] for p in (0.0, 0.2, 0.5, 0.9, 1.0)] == [0.0, 0.0, 1.0, 2.0, 2.0]
    assert max(sizes, default=0) <= 100 * 10


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_of_mixed_ties(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 4, 3000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0]
    q = quantile.exact_quantiles(df, ["x"], probs, leaf_rows=60)
    for p in probs:
        assert abs(q[("x", p)] - np.quantile(x, p)) < 1e-12


def test_positions_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 5)], "g string, v int")
    got = {(r["g"], r["v"]): r["p"] for r in rank.positions(df, ["g"], ["v"], "p").collect()}
    assert got == {(None, 1): 1, (None, 3): 2, ("a", 2): 1, ("a", 5): 2}


def test_ranks_and_quantiles_of_null_groups(spark):
    rows = [(g, float(v)) for g in (None, "a") for v in (1, 1, 2, 5, 5, 5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["v"]): r["rk"] for r in rank.average_ranks(df, ["g"], "v", "rk").collect()}
    assert got[(None, 1.0)] == got[("a", 1.0)] == 1.5 and got[(None, 5.0)] == 5.0
    q = quantile.grouped_quantiles(df, ["g"], "v", [0.25, 0.5], ["a", "b"]).collect()
    assert {(r["g"], r["a"], r["b"]) for r in q} == {(None, 1.25, 3.5), ("a", 1.25, 3.5)}


def test_tied_values_are_one_row(spark):
    df = spark.range(3000).select(F.lit(1).alias("g"), (F.col("id") % 3).cast("double").alias("v"))
    assert rank.running_counts(df, ["g"], "v").count() == 3


def test_stratified_folds_keep_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "x") for i in range(30)],
                               "id long, y string")
    assert modeling.stratified_folds(df, "y", ["id"]).count() == 30


def test_repeated_keys_are_refused(spark):
    df = spark.range(300).select(F.lit(1).alias("k")).withColumn("h", md5_key(["k"], 7))
    for leaf in (50, 1000):
        with pytest.raises(ValueError, match="not unique"):
            select.hash_thresholds(df, "h", {"__all__": 10}, {"__all__": 300}, leaf_rows=leaf)
    assert select.hash_thresholds(df, "h", {"__all__": 300}, {"__all__": 300}, leaf_rows=50)


SPEC = PanelSpec(key=("id",), group_keys=("g",), order_key=("t",), numeric=("x",))


@pytest.mark.parametrize("method", ["Forward Fill", "Backward Fill", "Linear Interpolation",
                                    "Polynomial Interpolation"])
def test_fills_agree_on_a_null_series(spark, method):
    rows = [(i, None if i % 2 else 1, i, float(i % 17) if i % 9 == 0 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g long, t long, x double")
    a, b = ({r["id"]: r["x"] for r in impute(df, SPEC, method, hot_rows=h).collect()}
            for h in (0, 10 ** 12))
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


@pytest.mark.parametrize("groups", [("g",), ()])
def test_halo_over_many_small_slices(spark, groups):
    rows = [(i, None if i % 5 == 0 else 2, i, float((i * 7) % 13)) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, g long, t long, x double")
    spec = PanelSpec(key=("id",), group_keys=groups, order_key=("t",), numeric=("x",))
    halo = series.with_halo(df, spec, 14, num_partitions=40)
    most = halo.where("_halo").groupBy("_slice", "g").count().agg(F.max("count")).first()[0]
    assert most <= 14 * (1 if groups else 2)
    cols = ["x_Lag_1", "x_Rolling_Mean_7", "x_Rolling_Median_7", "x_Moving_Average_14"]
    a, b = (features.temporal_features(df, spec, "x", warmup_fill=False, hot_rows=h)
            .orderBy("id").select(*cols).collect() for h in (0, 10 ** 12))
    assert a == b


def test_mice_leaves_nothing_cached(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *[None if rng.random() < 0.2 else float(v) for v in rng.normal(size=4)])
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = impute_mice(df, list("abcd"), dict.fromkeys("abcd", 0.0))
    assert out.count() == 300 and out.where("a IS NULL OR b IS NULL").count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_erfc_is_exact():
    x = np.linspace(-7, 12, 4001)
    want = np.array([math.erfc(v) for v in x])
    assert np.max(np.abs(erfc(x) - want) / np.maximum(want, 1e-300)) < 1e-9


def test_normality_statistics_on_all_values(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=6000), 2)  # ties, and more values than Shapiro's sample
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, x double")
    got = {r["test"]: r["statistic"] for r in stats.normality_tests(df, "x", ["id"]).collect()}
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    n, cdf = len(z), np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
    i = np.arange(1, n + 1)
    assert abs(got["Kolmogorov-Smirnov"] - max(np.max(i / n - cdf), np.max(cdf - (i - 1) / n))) < 1e-9
    a2 = -n - np.mean((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1])))
    assert abs(got["Anderson-Darling"] - a2) < 1e-6 * abs(a2)


def test_isolation_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *rng.normal(size=3).tolist()) for i in range(400)]
    rows += [(400 + k, 9.0 + k, -9.0, 9.0) for k in range(4)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out = outliers.isolation_forest_flags(df, ["id"], ["a", "b", "c"], n_trees=40)
    flagged = {r["id"] for r in out.where("IsolationForest_Outlier").collect()}
    assert {400, 401, 402, 403} <= flagged and len(flagged) <= 0.02 * len(rows) + 1
    same = df.select("id", *[F.lit(1.0).alias(c) for c in "abc"])
    assert outliers.isolation_forest_flags(same, ["id"], list("abc"), n_trees=10).where(
        "IsolationForest_Outlier").count() == 0


def test_boosted_stumps_survive_saving(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b), "abc"[int(a > 0) + int(b > 0)])
            for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y string")
    feats = modeling.Features(["a", "b"], [], "y")
    pre = modeling.fit_model("Decision Tree", df, feats, 200).pre
    model = modeling.SammeBoost(n_estimators=12).fit(pre.transform(df))
    chain = modeling._Chain(pre, model)
    modeling.save_model(chain, str(tmp_path / "m"))
    a = {r["id"]: r["prediction"] for r in chain.transform(df).select("id", "prediction").collect()}
    b = modeling.score_batch(str(tmp_path / "m"), df).collect()
    assert a == {r["id"]: r["prediction"] for r in b}
    assert all(0 < r["max_probability"] <= 1 for r in b)
    labels = chain.labels()
    assert np.mean([labels[int(a[r[0]])] == r[3] for r in rows]) > 0.8
