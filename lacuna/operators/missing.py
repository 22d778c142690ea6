"""Missingness: controlled masking (MCAR / MAR / MNAR), provenance and profiles.

Determinism: rows are chosen by the k smallest ``md5(key | column | seed)``
(never ``rand``), so Spark and DuckDB pick the same cells.  Exact counts come from
``select.hash_thresholds`` (aggregation passes, no global sort).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import DEFAULT_SEED, md5_key
from .quantile import exact_quantiles
from .select import hash_thresholds, mask_count, smallest_flag


@dataclass(frozen=True)
class MaskRule:
    column: str
    mechanism: str          # MCAR | MAR | MNAR
    rate: float
    rule: str = ""
    eligible: Column | None = None   # MAR: predicate on other (current) columns
    own_quantile: float | None = None  # MNAR: value >= q-quantile of the unmasked column


def mask_column(df: DataFrame, key_cols, column: str, rate: float,
                eligible: Column | None = None, seed: int = DEFAULT_SEED,
                flag: str | None = None) -> tuple[DataFrame, int]:
    """NULL exactly max(1, int(n_eligible * rate)) eligible cells of ``column``.

    Returns the masked frame (with a boolean ``flag`` column when asked) and the
    realised count.
    """
    h = "_mh"
    cond = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    tagged = df.withColumn(h, md5_key(key_cols, seed, column)).withColumn("_elig", cond)
    n = tagged.filter(F.col("_elig")).count()
    k = mask_count(n, rate)
    th = hash_thresholds(tagged.filter(F.col("_elig")), h, {"__all__": k}, {"__all__": n})
    hit = F.col("_elig") & smallest_flag(h, th)
    out = tagged.withColumn(column, F.when(hit, F.lit(None)).otherwise(F.col(column)))
    if flag:
        out = out.withColumn(flag, hit)
    return out.drop(h, "_elig"), k


def inject_missingness(df: DataFrame, key_cols, rules, seed: int = DEFAULT_SEED):
    """Apply rules in order; MAR predicates see earlier masks, MNAR reads the unmasked table.

    Returns (masked frame, provenance frame).  Provenance is aggregated from the
    mask flags, so it checks the realised counts rather than restating them.
    """
    complete = df
    masked = df
    flags = []
    meta = []
    for r in rules:
        elig = r.eligible
        if r.mechanism == "MNAR" and r.own_quantile is not None:
            q = exact_quantiles(complete, [r.column], [r.own_quantile])[(r.column, r.own_quantile)]
            # read the *unmasked* value: join-free because the column is masked only now
            elig = F.col(r.column) >= F.lit(q) if q is not None else F.lit(False)
        fl = f"_m_{r.column}"
        masked, _k = mask_column(masked, key_cols, r.column, r.rate, elig, seed, flag=fl)
        flags.append(fl)
        meta.append((r.column, r.mechanism, float(r.rate * 100), r.rule))
    if not flags:
        return masked, None
    counts = masked.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("mechanism"),
                 F.lit(p).alias("target_missing_percentage"),
                 F.col(f).cast("long").alias("realized_missing_rows"), F.lit(t).alias("rule"))
        for (c, m, p, t), f in zip(meta, flags)])).alias("s")).select("s.*")
    return masked.drop(*flags), stacked


def inject_duplicates(df: DataFrame, key_cols, n: int = 24, seed: int = DEFAULT_SEED) -> DataFrame:
    """Append ``n`` md5-chosen existing rows (full copies) to the table."""
    h = md5_key(key_cols, seed, "duplicate")
    tagged = df.withColumn("_dh", h)
    total = df.count()
    th = hash_thresholds(tagged, "_dh", {"__all__": min(n, total)}, {"__all__": total})
    dup = tagged.filter(smallest_flag("_dh", th)).drop("_dh")
    return df.unionByName(dup)


def missing_profile(df: DataFrame, cols=None) -> DataFrame:
    """Missing count and rate per column (C6 / C7), one aggregation pass."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"_c{i}").cast("long").alias("missing_count"),
                 (F.col(f"_c{i}") / F.col("_n")).alias("missing_rate"),
                 (F.col(f"_c{i}") * 100.0 / F.col("_n")).alias("missing_pct"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def sample_rows(df: DataFrame, key_cols, n: int, seed: int = DEFAULT_SEED,
                salt: str = "sample") -> DataFrame:
    """Exactly min(n, rows) rows chosen by md5 rank, without a global sort."""
    tagged = df.withColumn("_sh", md5_key(key_cols, seed, salt))
    total = df.count()
    th = hash_thresholds(tagged, "_sh", {"__all__": min(n, total)}, {"__all__": total})
    return tagged.filter(smallest_flag("_sh", th)).drop("_sh")


def null_matrix(df: DataFrame, key_cols, cols, n: int = 400, seed: int = DEFAULT_SEED) -> DataFrame:
    """Sampled null matrix (C8): (key..., column, is_null) for <= n md5-chosen rows."""
    s = sample_rows(df.select(*key_cols, *cols), key_cols, n, seed, salt="nullmatrix")
    return s.select(*key_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).isNull().alias("is_null")) for c in cols
    ])).alias("s")).select(*key_cols, "s.*")


def to_long(df: DataFrame, key_cols, cols, name: str = "feature",
            value: str = "value") -> DataFrame:
    """Wide -> long with values cast to double (one row per key and feature)."""
    return df.select(*key_cols, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(key_cols), list(cols), name, value)


def benchmark_masks(df: DataFrame, key_cols, cols, rate: float = 0.12,
                    seed: int = DEFAULT_SEED, min_known: int = 2) -> DataFrame:
    """Per feature, mask max(1, int(n_known * rate)) known cells, independently.

    Returns long rows (key..., feature, value, masked) for the known cells of every
    feature with at least ``min_known`` known values.
    """
    long = to_long(df, key_cols, cols).filter(F.col("value").isNotNull())
    long = long.withColumn("_bh", md5_key(list(key_cols) + ["feature"], seed))
    counts = {r["feature"]: r["n"] for r in
              long.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {f: n for f, n in counts.items() if n >= min_known}
    ks = {f: mask_count(n, rate) for f, n in counts.items()}
    th = hash_thresholds(long, "_bh", ks, counts, group_col="feature")
    return (long.filter(F.col("feature").isin(*counts.keys()) if counts else F.lit(False))
                .withColumn("masked", smallest_flag("_bh", th, "feature")).drop("_bh"))


def apply_long_masks(df: DataFrame, masks: DataFrame, key_cols, cols) -> DataFrame:
    """Wide table with the masked cells of ``masks`` set to NULL.

    The masked cells are pivoted back per key with a map-side-combined
    ``groupBy(key)`` and joined on the key (shuffle join; AQE may broadcast it).
    """
    flags = (masks.filter("masked").groupBy(*key_cols)
             .agg(F.collect_set("feature").alias("_masked_features")))
    joined = df.join(flags, list(key_cols), "left")
    out = joined.select(*[
        (F.when(F.array_contains(F.col("_masked_features"), F.lit(c)), F.lit(None))
          .otherwise(F.col(c)).alias(c)) if c in cols else F.col(c)
        for c in df.columns])
    return out
