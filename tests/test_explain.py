"""Permutations of columns are exact, and importances follow what a model uses."""

import numpy as np
import pytest

from lacuna.operators import explain, modeling


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_bijection_is_a_permutation(n):
    found = [explain.bijection(np.arange(n), n, key) for key in range(5)]
    for p in found:
        assert sorted(p.tolist()) == list(range(n))
    if n > 60:
        assert all((a != b).any() for a, b in zip(found, found[1:]))
        assert np.mean(found[0] == np.arange(n)) < 0.1


def frame(spark, n=300):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=n), rng.integers(0, 9, n)
    rows = [(i, float(x) if i % 11 else None, int(v), "pqr"[i % 3], "hi" if x > 0 else "lo", "clash")
            for i, (x, v) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "id long, a double, b long, c string, y string, s string").repartition(4)


def test_every_pair_permutes_one_column(spark):
    df = frame(spark)
    base = {r["id"]: r for r in df.collect()}
    got = {}
    for r in explain.permuted_rows(df, ["a", "b", "c"], ["id"], 2).collect():
        got.setdefault(r["_pair"], {})[r["id"]] = r
    assert set(got) == set(range(-1, 6)) and all(g.keys() == base.keys() for g in got.values())
    for pair, rows in got.items():
        for c in ("a", "b", "c", "y", "s"):
            same = [rows[i][c] == base[i][c] for i in base]
            if pair >= 0 and c == "abc"[pair // 2]:
                assert not all(same)
                assert sorted(str(r[c]) for r in rows.values()) == sorted(str(r[c]) for r in base.values())
            else:
                assert all(same)


def test_importance_follows_the_model(spark):
    df = frame(spark).drop("s")
    feats = modeling.Features(["a", "b"], ["c"], "y")
    chain = modeling.fit_model("Decision Tree", df, feats, 300)
    rows = explain.permutation_importance(chain, df, feats, ["id"]).collect()
    assert rows[0]["feature"] == "a" and rows[0]["importance_mean"] > 0.3
    assert {r["feature"] for r in rows} == {"a", "b", "c"} and abs(rows[-1]["importance_mean"]) < 0.1


def test_learning_curve_takes_all_rows(spark):
    df = frame(spark, 3900).drop("s")  # beyond the 3,500 rows that it was once drawn from
    feats = modeling.Features(["a", "b"], ["c"], "y")
    rows = explain.learning_curve(df, feats, ["id"], sizes=(0.5, 1.0)).collect()
    assert [r["train_rows"] for r in rows] == [1300, 2600]
    assert all(0.9 < r["validation_f1_macro"] <= 1 for r in rows)


def test_the_curves_build_their_panel_once(spark, monkeypatch):
    from datetime import date, timedelta
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from lacuna.plans import q_models

    rows = [(i, date(2020, 1, 1) + timedelta(days=i % 9)) for i in range(40)]
    facts = spark.createDataFrame(rows, "o_orderkey long, o_orderdate date").withColumn("v", F.col("o_orderkey") * 2)
    cut = []
    monkeypatch.setattr(q_models, "order_facts", lambda *_: facts)
    monkeypatch.setattr(q_models, "cut_lineage", lambda df: cut.append(df.count()) or df)
    monkeypatch.setattr(q_models, "modeling", SimpleNamespace(
        chronological_split=q_models.modeling.chronological_split, fit_model=lambda *a: a[1].count()))
    train = q_models._curve_rows(spark, "")
    assert cut == [40] and train.count() == 30
    cut.clear()
    _fit, train, test = q_models._tree(spark, "")
    assert cut == [30, 10] and (train.count(), test.count()) == (30, 10)
