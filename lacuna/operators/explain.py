"""Model diagnostics as tables (K6-K11): learning / validation curves, permutation
importance, partial dependence, tree importances.

Subsets are exact md5 samples; permutations are keyed bijections of distributed
positions (``rank.positions``), all scored in one pass.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import DEFAULT_SEED, md5_key
from ..session import cut_lineage
from . import evaluate
from .missing import sample_rows
from .modeling import LABEL, Features, _scored, fit_model, stratified_folds
from .quantile import exact_quantiles
from .rank import positions


def _f1(chain, df) -> float:
    return evaluate.summary_metrics(_scored(chain, df), "actual", "predicted").first()["f1_macro"]


def learning_curve(df: DataFrame, feats: Features, key_cols, model: str = "Decision Tree",
                   sizes=(0.25, 0.5, 0.75, 1.0), k: int = 3, max_rows: int | None = None,
                   seed: int = DEFAULT_SEED) -> DataFrame:
    """K6: mean train / validation macro F1 per training size (nested md5 subsets).

    All rows of ``df`` lie in the folds unless the caller asks for an exact md5 sample
    (``max_rows``).
    """
    spark = df.sparkSession
    base = sample_rows(df, key_cols, max_rows, seed, salt="learning") if max_rows else df
    folded = stratified_folds(base, feats.label, key_cols, k, seed)
    folded = folded.withColumn("_sub", md5_key(key_cols, seed, "subset"))
    folded = cut_lineage(positions(folded.withColumn("_all", F.lit(1)), ["_all"],
                                   ["_sub", *key_cols], "_spos").drop("_all"))
    n = folded.count()

    def run(size, f):
        # nested subsets: the first ``size`` share of rows in md5 order, minus the fold
        tr = folded.filter((F.col("fold") != f) & (F.col("_spos") <= F.lit(int(n * size))))
        m = tr.count()
        chain = fit_model(model, tr, feats, m, seed)
        return _f1(chain, tr), _f1(chain, folded.filter(F.col("fold") == f)), m

    rows = []
    with ThreadPoolExecutor(max_workers=k) as pool:
        for size in sizes:
            res = list(pool.map(lambda f: run(size, f), range(k)))
            rows.append((float(size), int(sum(r[2] for r in res) / k),
                         sum(r[0] for r in res) / k, sum(r[1] for r in res) / k))
    return spark.createDataFrame(rows, "train_fraction double, train_rows long, "
                                       "train_f1_macro double, validation_f1_macro double")


def validation_curve(df: DataFrame, feats: Features, key_cols, model: str = "Decision Tree",
                     depths=(4, 8, 12, 16), k: int = 3, max_rows: int | None = 3500,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """K7: train / validation macro F1 over maxDepth (models with a depth only).

    ``max_rows`` bounds the rows that models are fitted to, by cross-validation on an
    exact md5 sample; ``None`` takes all rows.
    """
    spark = df.sparkSession
    base = sample_rows(df, key_cols, max_rows, seed, salt="learning") if max_rows else df
    folded = cut_lineage(stratified_folds(base, feats.label, key_cols, k, seed))

    def run(depth, f):
        tr = folded.filter(F.col("fold") != f)
        chain = fit_model(model, tr, feats, tr.count(), seed, {"maxDepth": depth})
        return _f1(chain, tr), _f1(chain, folded.filter(F.col("fold") == f))

    rows = []
    with ThreadPoolExecutor(max_workers=k) as pool:
        for d in depths:
            res = list(pool.map(lambda f: run(d, f), range(k)))
            rows.append((int(d), sum(r[0] for r in res) / k, sum(r[1] for r in res) / k))
    return spark.createDataFrame(rows, "max_depth int, train_f1_macro double, "
                                       "validation_f1_macro double")


def bijection(at: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1, place by place: four Feistel rounds over the halves of the
    place's bits, repeated for places that fall outside until they come back in."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = np.array(at, np.uint64)
    live = np.arange(len(out))
    while len(live):
        left, right = out[live] >> np.uint64(half), out[live] & mask
        for r in range(4):
            x = right + np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & mask)
        out[live] = left << np.uint64(half) | right
        live = live[out[live] >= n]
    return out.astype(np.int64)


def permuted_rows(base: DataFrame, columns, key_cols, repeats: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Each row once as it is (``_pair`` = -1) and once per (column, repeat) with that column's value of
    another row: ``_pair`` = column * repeats + repeat, each an exact permutation of the column.

    One position pass; the value at place s is sent to place ``bijection(s)``, narrow, and meets the row
    there by one join for all pairs.
    """
    columns = list(columns)
    kinds = {c: base.schema[c].dataType for c in columns}
    text = {c: kinds[c].simpleString() == "string" for c in columns}
    n = base.count()
    placed = positions(base, [], list(key_cols), "_at")
    sent = placed.select((F.col("_at") - 1).alias("s"),
                         F.array(*[F.lit(None).cast("double") if text[c] else F.col(c).cast("double")
                                   for c in columns]).alias("num"),
                         F.array(*[F.col(c) if text[c] else F.lit(None).cast("string")
                                   for c in columns]).alias("txt"))
    pairs = len(columns) * repeats

    def send(batches):
        for b in batches:
            s = b.column(0).to_numpy()
            num, txt = (b.column(k).flatten() for k in (1, 2))
            for pair in range(-1, pairs):
                c = max(pair, 0) // repeats
                take = pa.array(np.arange(len(s)) * len(columns) + c)
                to = s if pair < 0 else bijection(s, n, seed * 1_000_003 + pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), pa.array(np.full(len(s), pair)), num.take(take), txt.take(take)],
                    names=["_to", "_pair", "_num", "_txt"])

    values = sent.mapInArrow(send, "_to long, _pair long, _num double, _txt string")
    rows = placed.join(values, F.col("_at") == F.col("_to") + 1)
    swapped = {c: F.when(F.floor(F.col("_pair") / repeats) == i, F.col("_txt" if text[c] else "_num").cast(kinds[c]))
               .otherwise(F.col(c)) for i, c in enumerate(columns)}
    return rows.withColumns(swapped).drop("_at", "_to", "_num", "_txt")


def permutation_importance(chain, test: DataFrame, feats: Features, key_cols,
                           repeats: int = 5, max_rows: int | None = None,
                           seed: int = DEFAULT_SEED) -> DataFrame:
    """K8: mean / std drop of macro F1 when one feature is permuted, sorted descending.

    All rows of ``test`` count unless the caller asks for a sample (``max_rows``).  All
    permutations are scored in one pass.
    """
    from .selection import scores
    spark = test.sparkSession
    base = sample_rows(test, key_cols, max_rows, seed, salt="importance") if max_rows else test
    columns = list(feats.numeric) + list(feats.categorical)
    scored = chain.transform(permuted_rows(base, columns, key_cols, repeats, seed))
    k = len(chain.labels())
    counts = np.zeros((len(columns) * repeats + 1, k, k))
    for r in scored.groupBy("_pair", F.col(LABEL).cast("int").alias("y"), F.col("prediction").cast("int").alias("p")) \
            .agg(F.count(F.lit(1)).alias("n")).collect():  # pairs x classes x classes
        counts[r["_pair"] + 1, r["y"], r["p"]] = r["n"]
    f1 = [scores(c)["f1_macro"] for c in counts]
    drops = f1[0] - np.array(f1[1:]).reshape(len(columns), repeats)
    rows = [(c, float(d.mean()), float(d.std())) for c, d in zip(columns, drops)]
    out = spark.createDataFrame(rows, "feature string, importance_mean double, importance_std double")
    return out.orderBy(F.col("importance_mean").desc(), "feature")


def top_importances(imp: DataFrame, n: int = 15) -> DataFrame:
    """K9: the ``n`` largest mean importances (a top-k report)."""
    return imp.orderBy(F.col("importance_mean").desc(), "feature").limit(n)


def partial_dependence(chain, df: DataFrame, feats: Features, key_cols, positive: str,
                       columns=None, grid: int = 100, max_rows: int | None = None,
                       seed: int = DEFAULT_SEED) -> DataFrame:
    """Mean predicted probability of ``positive`` with one column set to each grid value.

    Grid: ``grid`` evenly spaced values between the 5th and 95th percentile of all rows
    (or of a sample of ``max_rows``, if asked for).  Each row is replicated once per grid value (a fixed factor), never joined
    to other rows.
    """
    from pyspark.ml.functions import vector_to_array
    base = sample_rows(df, key_cols, max_rows, seed, salt="pdp") if max_rows else df
    base = cut_lineage(base)
    labels = chain.labels()
    if positive not in labels:
        return df.sparkSession.createDataFrame([], "feature string, grid_value double, "
                                                   "mean_probability double")
    pi = labels.index(positive)
    cols = list(columns or feats.numeric[:2])
    out = None
    for c in cols:
        q = exact_quantiles(base, [c], [0.05, 0.95])
        lo, hi = q[(c, 0.05)], q[(c, 0.95)]
        if lo is None:
            continue
        vals = [lo + (hi - lo) * i / (grid - 1) for i in range(grid)] if hi > lo else [lo]
        rep = base.withColumn("_g", F.explode(F.array(*[F.lit(float(v)) for v in vals])))
        rep = rep.withColumn(c, F.col("_g"))
        pr = chain.transform(rep)
        if "probability" not in pr.columns:
            continue
        agg = pr.groupBy("_g").agg(F.avg(vector_to_array("probability")[pi]).alias("mean_probability"))
        agg = agg.select(F.lit(c).alias("feature"), F.col("_g").alias("grid_value"), "mean_probability")
        out = agg if out is None else out.unionByName(agg)
    return out


def tree_importances(chain, feats: Features) -> DataFrame:
    """MLlib ``featureImportances`` mapped back to input columns (one-hot summed)."""
    model = chain.model
    imp = getattr(model, "featureImportances", None)
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if imp is None:
        return spark.createDataFrame([], "feature string, importance double")
    # vector layout: scaled numerics, then one one-hot block per categorical
    names = list(feats.numeric)
    sizes = {}
    for st in chain.pre.stages:
        if type(st).__name__ == "OneHotEncoderModel":
            sizes = dict(zip(feats.categorical, st.categorySizes))
    for c in feats.categorical:
        names += [c] * (sizes.get(c, 1) + 1)   # dropLast=False + the invalid bucket
    arr = imp.toArray()
    agg: dict[str, float] = {}
    for i, v in enumerate(arr):
        nm = names[i] if i < len(names) else f"f{i}"
        agg[nm] = agg.get(nm, 0.0) + float(v)
    rows = sorted(agg.items(), key=lambda kv: -kv[1])
    return spark.createDataFrame(rows, "feature string, importance double")
