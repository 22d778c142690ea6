"""Outlier fences (F1) and isolation-forest flags (F2).

F1 is two passes over the data whatever the number of columns: one quantile
computation (``exact_quantiles``) and one aggregation counting points outside
the fences.  F2 grows trees in parallel with ``applyInPandas`` (one group per
tree, each on an md5-chosen subsample of at most 256 rows) and scores every
row with ``mapInPandas`` against the broadcast forest (150 small trees).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import DEFAULT_SEED, finite_or_null, md5_key
from .quantile import exact_quantiles


def iqr_summary(df: DataFrame, cols, k: float = 1.5) -> DataFrame:
    """Per column: lower/upper fence, outlier count and rate (% of non-NULL values)."""
    cols = [c for c in cols if c in df.columns]
    clean = df.select(*[finite_or_null(F.col(c).cast("double")).alias(c) for c in cols])
    clean = clean.persist(StorageLevel.MEMORY_AND_DISK)  # read for the fences and for the counts
    q = exact_quantiles(clean, cols, [0.25, 0.75])
    fences = {}
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            fences[c] = (None, None)
        else:
            iqr = q3 - q1
            fences[c] = (q1 - k * iqr, q3 + k * iqr)
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = fences[c]
        x = F.col(c)
        out = F.lit(False) if lo is None else ((x < F.lit(lo)) | (x > F.lit(hi)))
        aggs += [F.count_if(x.isNotNull() & out).alias(f"o{i}"), F.count(x).alias(f"n{i}")]
    row = clean.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.lit(fences[c][0]).cast("double").alias("lower_bound"),
                 F.lit(fences[c][1]).cast("double").alias("upper_bound"),
                 F.col(f"o{i}").cast("long").alias("outlier_count"),
                 F.when(F.col(f"n{i}") > 0, F.col(f"o{i}") * 100.0 / F.col(f"n{i}"))
                  .otherwise(F.lit(0.0)).alias("outlier_rate_pct"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def iqr_flags(df: DataFrame, cols, k: float = 1.5, suffix: str = "_IQR_Outlier") -> DataFrame:
    """Row-level fence flags (reported, never removed)."""
    clean = df.select(*[finite_or_null(F.col(c).cast("double")).alias(c) for c in cols])
    q = exact_quantiles(clean, cols, [0.25, 0.75])
    out = df
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            out = out.withColumn(f"{c}{suffix}", F.lit(False))
            continue
        iqr = q3 - q1
        x = finite_or_null(F.col(c).cast("double"))
        out = out.withColumn(f"{c}{suffix}", F.coalesce(
            (x < F.lit(q1 - k * iqr)) | (x > F.lit(q3 + k * iqr)), F.lit(False)))
    return out


# ---------------------------------------------------------------- isolation forest
_AT_ONCE = 2048  # rows that walk the trees together: they stay in the cache


def _c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, depth: int, limit: int, nodes: list) -> int:
    idx = len(nodes)
    nodes.append(None)
    n = len(x)
    if depth >= limit or n <= 1:
        nodes[idx] = (-1, 0.0, -1, -1, float(n))
        return idx
    lo, hi = x.min(axis=0), x.max(axis=0)
    span = np.flatnonzero(hi > lo)
    if span.size == 0:
        nodes[idx] = (-1, 0.0, -1, -1, float(n))
        return idx
    f = int(rng.choice(span))
    t = float(rng.uniform(lo[f], hi[f]))
    left = x[x[:, f] < t]
    right = x[x[:, f] >= t]
    li = _grow(left, rng, depth + 1, limit, nodes)
    ri = _grow(right, rng, depth + 1, limit, nodes)
    nodes[idx] = (f, t, li, ri, float(n))
    return idx


def _c_factor_vec(n: np.ndarray) -> np.ndarray:
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + 0.5772156649015329) - 2.0 * (nb - 1.0) / nb
    return out


def _steps(arr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """A tree as steps without branches: feature, threshold, both children (a leaf's are
    itself), path length at each leaf, and the depth."""
    inner = arr[:, 0] >= 0
    feature = np.where(inner, arr[:, 0], 0).astype(np.intp)
    own = np.arange(len(arr))
    sides = np.where(inner[:, None], arr[:, 2:4], own[:, None]).astype(np.intp)
    depth = np.zeros(len(arr))
    for i in np.flatnonzero(inner):  # children come after their parent
        depth[sides[i]] = depth[i] + 1
    return feature, arr[:, 1].copy(), sides.ravel(), depth + _c_factor_vec(arr[:, 4]), int(depth.max())


def _path_length(steps: tuple, x: np.ndarray) -> np.ndarray:
    """Path length of every row of ``x`` through one tree of ``_steps``."""
    feature, threshold, sides, length, depth = steps
    flat, width = np.ascontiguousarray(x).ravel(), x.shape[1]
    base = np.arange(len(x)) * width
    cur = np.zeros(len(x), dtype=np.intp)
    for _ in range(depth):
        right = ~(flat[base + feature[cur]] < threshold[cur])
        cur = sides[2 * cur + right]
    return length[cur]


def isolation_forest_scores(df: DataFrame, key_cols, cols, n_trees: int = 150,
                            sample_size: int = 256, seed: int = DEFAULT_SEED) -> DataFrame:
    """Anomaly score s = 2^(-E[h(x)] / c(psi)) per row (higher = more isolated).

    Trees are grown in parallel (``groupBy(tree).applyInPandas``) on subsamples
    chosen by hash: a row enters a tree at most once; only the
    per-tree subsample (<= ``sample_size`` rows) reaches a task.  The forest is
    a few thousand numbers: collected once and broadcast to the scoring tasks.
    """
    spark = df.sparkSession
    cols = list(cols)
    feats = df.select(*key_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    med = exact_quantiles(feats, cols, [0.5])
    filled = feats.select(*key_cols, *[F.coalesce(F.col(c), F.lit(med[(c, 0.5)] or 0.0)).alias(c)
                                       for c in cols])
    n = filled.count()
    psi = min(sample_size, n)
    if psi < 2:
        return filled.select(*key_cols, F.lit(0.0).alias("anomaly_score"))
    # each row enters each tree's draw on its own, by a hash of key and tree: a slightly
    # oversized uniform share, of which the psi smallest hashes are the sample
    share = min(1.0, 1.5 * psi / n)
    space = float(1 << 31)
    trees = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(
            t.alias("tree"), F.pmod(F.xxhash64(*key_cols, F.lit(seed), t), F.lit(1 << 31)).alias("_u"))),
        lambda x: x["_u"] < F.lit(share * space))
    cand = filled.select("*", F.explode(trees).alias("_d")).select(
        *filled.columns, F.col("_d.tree").alias("tree"), F.col("_d._u").alias("_u"))
    w = Window.partitionBy("tree").orderBy("_u", *key_cols)   # ~1.5 psi rows per tree
    per_tree = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi)
    limit = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed + t)
        nodes: list = []
        _grow(pdf[cols].to_numpy(dtype=float), rng, 0, limit, nodes)
        arr = np.array(nodes, dtype=float)
        return pd.DataFrame({"tree": t, "node": np.arange(len(arr)), "f": arr[:, 0],
                             "t": arr[:, 1], "l": arr[:, 2], "r": arr[:, 3], "n": arr[:, 4]})

    forest = per_tree.select("tree", *cols).groupBy("tree").applyInPandas(
        grow, "tree long, node long, f double, t double, l double, r double, n double")
    rows = forest.orderBy("tree", "node").collect()   # n_trees x <= 2*psi nodes: bounded
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["tree"], []).append((r["f"], r["t"], r["l"], r["r"], r["n"]))
    arrays = [_steps(np.array(v, dtype=float)) for v in by_tree.values()]
    bc = spark.sparkContext.broadcast(arrays)
    cpsi = _c_factor(psi)
    out_schema = ", ".join([f"{k} {t}" for k, t in filled.select(*key_cols).dtypes] +
                           ["anomaly_score double"])

    def score(it):
        forest_ = bc.value
        for pdf in it:
            x = pdf[cols].to_numpy(dtype=float)
            h = np.zeros(len(x))
            for lo in range(0, len(x), _AT_ONCE):
                for steps in forest_:
                    h[lo:lo + _AT_ONCE] += _path_length(steps, x[lo:lo + _AT_ONCE])
            h /= max(len(forest_), 1)
            res = pdf[list(key_cols)].copy()
            res["anomaly_score"] = np.power(2.0, -h / cpsi) if cpsi > 0 else 0.0
            yield res

    return filled.mapInPandas(score, out_schema)


def isolation_forest_flags(df: DataFrame, key_cols, cols, contamination: float = 0.02,
                           **kw) -> DataFrame:
    """F2: flag the ``contamination`` share of rows with the highest anomaly score.

    Threshold = exact (1 - contamination) quantile of the scores.  Degenerate
    input (fewer than 2 rows or constant columns) flags nothing.
    """
    if not 0 < contamination < 0.5:
        raise ValueError("contamination must be in (0, 0.5)")
    scores = isolation_forest_scores(df, key_cols, cols, **kw)
    from ..session import cut_lineage
    scores = cut_lineage(scores)
    thr = exact_quantiles(scores, ["anomaly_score"], [1 - contamination])[
        ("anomaly_score", 1 - contamination)]
    flag = F.lit(False) if thr is None else F.col("anomaly_score") > F.lit(thr)
    return scores.withColumn("IsolationForest_Outlier", flag)
