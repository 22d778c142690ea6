"""End-to-end plan, file sources / sinks and the streaming repair on sf0.001."""

import os
import tempfile

from pyspark.sql import functions as F

from lacuna.plans.end_to_end import run_repair_project
from lacuna.sources import files
from lacuna.sources.tables import events_series, read_table
from lacuna.spec import EVENTS
from lacuna.streaming.repair import apply_fill_values, fit_fill_values, start_stream_repair


def test_end_to_end_small(spark, sf_small):
    out_dir = tempfile.mkdtemp(prefix="lacuna-e2e-")
    res = run_repair_project(spark, sf_dir=sf_small,
                             methods=["Median", "Forward Fill", "Linear Interpolation",
                                      "Regression Imputation"],
                             models=["Logistic Regression", "Decision Tree"], out_dir=out_dir)
    s = res["summary"]
    assert s["duplicates_removed"] == 24
    assert s["best_model"] in ("Logistic Regression", "Decision Tree")
    rep = res["repaired"]
    assert rep.filter(F.col("qty").isNull() | F.col("extprice").isNull()).count() == 0
    assert os.path.isdir(os.path.join(out_dir, "summary"))
    assert spark.read.parquet(os.path.join(out_dir, "metrics")).count() > 0


def test_csv_scan_contract(spark, sf_small):
    d = tempfile.mkdtemp(prefix="lacuna-csv-")
    o = read_table(spark, sf_small, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), "o_totalprice")
    files.write_table(o, d, fmt="csv")
    df = files.load_panel_csv(spark, d)
    assert df.count() == o.count()
    assert dict(df.dtypes)["Date"] == "date"


def test_stream_repair_matches_batch(spark, sf_small):
    ev = events_series(spark, sf_small)
    fills = fit_fill_values(ev, EVENTS, "Median")
    src = tempfile.mkdtemp(prefix="lacuna-src-")
    ev.withColumn("value", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value"))) \
      .write.mode("overwrite").parquet(src)
    sink = tempfile.mkdtemp(prefix="lacuna-sink-")
    ck = tempfile.mkdtemp(prefix="lacuna-ck-")
    schema = spark.read.parquet(src).schema
    q = start_stream_repair(spark, src, schema, fills, sink, ck)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = apply_fill_values(spark.read.parquet(src), fills)
    assert streamed.count() == batch.count()
    assert streamed.filter(F.col("value").isNull()).count() == 0
    assert streamed.exceptAll(batch).count() == 0


def test_model_save_and_batch_scoring(spark, sf_small):
    from lacuna.operators import modeling
    from lacuna.sources.tables import order_facts
    feats = modeling.Features(["o_totalprice", "qty"], ["c_mktsegment"], "o_orderstatus")
    df = order_facts(spark, sf_small)
    chain = modeling.fit_model("Logistic Regression", df, feats, df.count())
    path = tempfile.mkdtemp(prefix="lacuna-model-")
    modeling.save_model(chain, path)
    scored = modeling.score_batch(path, df)
    assert scored.count() == df.count()
    assert scored.filter((F.col("max_probability") < 0) | (F.col("max_probability") > 1)).count() == 0
