"""EDA tables (I1-I10): the data behind each figure, as DataFrames.

All are single aggregation passes (partial aggregation map-side); samples use
the exact md5 selection of ``missing.sample_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .missing import missing_profile, sample_rows


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Pairwise-complete Pearson r for every ordered pair, long form."""
    cols = list(cols)
    aggs = []
    names = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}_{j}"))
            names.append((i, j))
    row = df.agg(*aggs)
    structs = []
    for i, j in names:
        structs.append(F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"),
                                F.col(f"c{i}_{j}").alias("corr")))
        if i != j:
            structs.append(F.struct(F.lit(cols[j]).alias("feature_a"),
                                    F.lit(cols[i]).alias("feature_b"),
                                    F.col(f"c{i}_{j}").alias("corr")))
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def histogram(df: DataFrame, col: str, bins: int = 35) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin includes the max."""
    mm = df.agg(F.min(F.col(col).cast("double")).alias("lo"),
                F.max(F.col(col).cast("double")).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_lower double, bin_upper double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int") \
        if hi > lo else F.lit(0)
    return (df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
              .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lower"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_upper"),
                      "count"))


def five_number_summary(df: DataFrame, value: str, by) -> DataFrame:
    """Min, q1, median, q3, max of ``value`` per category (box / violin data)."""
    from .quantile import grouped_quantiles
    by = [by] if isinstance(by, str) else list(by)
    x = F.col(value).cast("double")
    q = grouped_quantiles(df, by, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    mm = df.groupBy(*by).agg(F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("n"))
    return mm.join(q, by, "left").select(*by, "min", "q1", "median", "q3", "max", "n")


def mean_by(df: DataFrame, value: str, by, descending: bool = False) -> DataFrame:
    """Mean of ``value`` per group (ordering applied at the sink)."""
    by = [by] if isinstance(by, str) else list(by)
    out = df.groupBy(*by).agg(F.avg(F.col(value).cast("double")).alias(f"mean_{value}"),
                              F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col(f"mean_{value}").desc()) if descending else out


def trend(df: DataFrame, value: str, date_col: str, grain: str = "day") -> DataFrame:
    """Daily or monthly mean of ``value``."""
    d = F.to_date(F.col(date_col)) if grain == "day" else F.trunc(F.to_date(F.col(date_col)), "month")
    return df.groupBy(d.alias("period")).agg(F.avg(F.col(value).cast("double")).alias(f"mean_{value}"),
                                             F.count(F.lit(1)).alias("n"))


def cube_means(df: DataFrame, value: str, a: str, b: str) -> DataFrame:
    """I6 as a cube: means per (a, b), per a, per b and overall."""
    return df.cube(a, b).agg(F.avg(F.col(value).cast("double")).alias(f"mean_{value}"),
                             F.count(F.lit(1)).alias("n"))


def scatter_sample(df: DataFrame, key_cols, cols, n: int = 2500, seed: int = 42) -> DataFrame:
    """Exact md5 sample of at most ``n`` rows for scatter / pair plots."""
    return sample_rows(df.select(*key_cols, *cols), key_cols, n, seed, salt="scatter")


def schema_profile(df: DataFrame) -> DataFrame:
    """Column name, Spark type and missing count / rate."""
    prof = missing_profile(df)
    spark = df.sparkSession
    types = spark.createDataFrame([(c, t) for c, t in df.dtypes], "column_name string, data_type string")
    return types.join(prof, "column_name")
