"""Cheap baseline scorers (L1-L4): a fixed rule and a nearest-centroid classifier.

Both are column expressions over the table; the centroid fit is one grouped
aggregation (class means) plus one global aggregation (population sd), whose
results (classes x features numbers) are inlined as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import risk_class

# Fixed values of the task: rule weights and the defaults for absent inputs.
RULE_INTERCEPT = 52.0
RULE_WEIGHTS = {"Admissions": 0.65, "Emergency_Cases": 0.38, "Staff_On_Duty": -0.30,
                "Nurses": -0.18, "Doctors": 1.2}
RULE_DEFAULTS = {"Admissions": 20.0, "Emergency_Cases": 20.0, "Staff_On_Duty": 35.0,
                 "Nurses": 20.0, "Doctors": 8.0}
RULE_FLOORED = ("Staff_On_Duty", "Doctors")
CENTROID_CLASS_ORDER = ("Low", "Moderate", "High")   # tie-break order of the argmin
PROBA_CLASS_ORDER = ("High", "Low", "Moderate")


def rule_score(mapping: dict | None = None) -> Column:
    """L1 score.  ``mapping`` maps rule inputs to table columns; absent -> default."""
    mapping = mapping or {}
    s = F.lit(RULE_INTERCEPT)
    for name, w in RULE_WEIGHTS.items():
        c = mapping.get(name)
        x = F.lit(RULE_DEFAULTS[name]) if c is None else F.coalesce(
            F.col(c).cast("double"), F.lit(RULE_DEFAULTS[name]))
        if name in RULE_FLOORED:
            x = F.greatest(x, F.lit(1.0))
        s = s + F.lit(w) * x
    return s


def rule_predict(df: DataFrame, mapping: dict | None = None, out: str = "rule_class") -> DataFrame:
    return df.withColumn("rule_score", rule_score(mapping)).withColumn(
        out, risk_class("rule_score"))


def centroid_fit(df: DataFrame, features, label: str) -> dict:
    """L2: class means and population sd (0 -> 1) per feature."""
    feats = list(features)
    means = df.groupBy(label).agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in feats])
    centroids = {r[label]: {f: r[f] for f in feats} for r in means.collect()}  # classes x feats
    sd = df.agg(*[F.stddev_pop(F.col(f).cast("double")).alias(f) for f in feats]).first()
    scales = {f: (sd[f] or 1.0) for f in feats}
    return {"features": feats, "centroids": centroids, "scales": scales}


def _distance(model: dict, cls: str) -> Column:
    d = None
    for f in model["features"]:
        z = (F.col(f).cast("double") - F.lit(model["centroids"][cls][f])) / F.lit(model["scales"][f])
        d = z * z if d is None else d + z * z
    return d


def centroid_predict(df: DataFrame, model: dict, out: str = "centroid_class") -> DataFrame:
    """L3: argmin scaled squared distance (ties -> Low, Moderate, High order)."""
    classes = class_order(model)
    dists = [(c, _distance(model, c)) for c in classes]
    # fold: keep the first class with the smallest distance
    pick = None
    for i, (c, d) in enumerate(dists):
        cond = None
        for j, (c2, d2) in enumerate(dists):
            if j == i:
                continue
            term = (d < d2) if j < i else (d <= d2)
            cond = term if cond is None else (cond & term)
        cond = F.lit(True) if cond is None else cond
        pick = F.when(cond, F.lit(c)) if pick is None else pick.when(cond, F.lit(c))
    return df.withColumn(out, pick)


def class_order(model: dict) -> list:
    """Census classes in their fixed order, any other labels after them, sorted."""
    classes = [c for c in CENTROID_CLASS_ORDER if c in model["centroids"]]
    return classes + sorted(c for c in model["centroids"] if c not in classes)


def centroid_proba(df: DataFrame, model: dict, prefix: str = "proba_") -> DataFrame:
    """L4: normalised inverse distances 1 / (1 + d) per class."""
    classes = [c for c in PROBA_CLASS_ORDER if c in model["centroids"]]
    classes += sorted(c for c in model["centroids"] if c not in classes)
    scores = {c: F.lit(1.0) / (F.lit(1.0) + _distance(model, c)) for c in classes}
    total = None
    for s in scores.values():
        total = s if total is None else total + s
    out = df
    for c, s in scores.items():
        out = out.withColumn(f"{prefix}{c}", s / total)
    return out
