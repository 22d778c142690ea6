"""A fitted repair applied to a stream (stream-static, stateless).

The batch operators fit fill values (median / mean / mode per numeric column,
mode per categorical) on a reference table; the same repair is then a pure
column expression, so it runs per micro-batch in Structured Streaming with no
state.  Order-dependent methods (forward fill, interpolation) need state across
batches and are not offered on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import finite_or_null
from ..operators.impute import fallback_values, numeric_modes, string_modes
from ..spec import PanelSpec


def fit_fill_values(reference: DataFrame, spec: PanelSpec, method: str = "Median") -> dict:
    """Fill values from a static table: {"numeric": {col: v}, "categorical": {col: v}}."""
    spec = spec.present(reference)
    cols = list(spec.numeric)
    clean = reference.select(*[finite_or_null(F.col(c).cast("double")).alias(c) for c in cols],
                             *spec.categorical)
    fb = fallback_values(clean, cols)
    if method == "Mean":
        means = clean.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
        num = {c: means[c] if means[c] is not None else fb[c] for c in cols}
    elif method == "Mode":
        modes = numeric_modes(clean, cols)
        num = {c: modes.get(c, fb[c]) for c in cols}
    elif method == "Median":
        num = fb
    else:
        raise ValueError(f"{method} needs order across batches; not a stream repair")
    cats = string_modes(clean, list(spec.categorical))
    return {"numeric": num, "categorical": {c: cats.get(c) or "Unknown" for c in spec.categorical}}


def apply_fill_values(df: DataFrame, fills: dict) -> DataFrame:
    """Coalesce every gap with its fitted value (works on batch and streaming frames)."""
    num, cat = fills["numeric"], fills["categorical"]
    return df.select(*[
        F.coalesce(finite_or_null(F.col(c).cast("double")), F.lit(num[c])).alias(c) if c in num
        else F.coalesce(F.col(c).cast("string"), F.lit(cat[c])).alias(c) if c in cat
        else F.col(c) for c in df.columns])


def start_stream_repair(spark, source_path: str, schema, fills: dict, sink_path: str,
                        checkpoint_path: str, fmt: str = "parquet", trigger_once: bool = True):
    """readStream -> repair -> writeStream (exactly-once file sink with a checkpoint)."""
    stream = spark.readStream.schema(schema).parquet(source_path)
    q = (apply_fill_values(stream, fills).writeStream.format(fmt)
         .option("checkpointLocation", checkpoint_path).option("path", sink_path)
         .outputMode("append"))
    q = q.trigger(availableNow=True) if trigger_once else q
    return q.start()
