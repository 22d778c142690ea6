"""The whole repair project as one Spark plan sequence (the reference's CLI run).

mask + duplicate -> clean -> benchmark -> policy repair -> outliers -> features
-> normalise -> statistics -> EDA -> train / evaluate -> summary, on any panel
described by a ``PanelSpec`` (default: the ``order_facts`` view of the driver
tables).  Every stage is a DataFrame transformation; stage outputs are written
with the A2/A3 sinks when ``out_dir`` is given.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, eda, evaluate, features, modeling, outliers, selection, stats
from ..operators.impute import METHODS, repair_with_policy
from ..operators.missing import MaskRule, inject_duplicates, inject_missingness, missing_profile
from ..operators.scoring import benchmark, best_method
from ..session import cut_lineage
from ..sources.files import write_summary, write_table
from ..sources.tables import order_facts
from ..spec import ORDER_FACTS, PanelSpec

def default_rules():
    """MCAR / MAR / MNAR rules for the order_facts panel (built lazily: they hold Columns)."""
    return [
    MaskRule("qty", "MCAR", 0.07, "Uniform random 7% mask."),
    MaskRule("extprice", "MAR", 0.10, "10% in two market segments.",
             eligible=F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")),
    MaskRule("c_mktsegment", "MCAR", 0.04, "Uniform random 4% mask."),
    MaskRule("o_totalprice", "MNAR", 0.22, "22% of high order totals.", own_quantile=0.72),
    ]


def run_repair_project(spark: SparkSession, panel: DataFrame | None = None,
                       spec: PanelSpec = ORDER_FACTS, sf_dir: str | None = None,
                       label: str = "o_orderstatus", rules=None, methods=None, models=None,
                       benchmark_rows: int | None = None, out_dir: str | None = None) -> dict:
    t0 = time.perf_counter()
    timings = {}

    def lap(name):
        nonlocal t0
        now = time.perf_counter()
        timings[name] = round(now - t0, 3)
        t0 = now

    complete = panel if panel is not None else order_facts(spark, sf_dir)
    complete = cut_lineage(complete)
    key = list(spec.key)
    raw, provenance = inject_missingness(complete, key, rules or default_rules())
    raw = cut_lineage(inject_duplicates(raw, key, 24))
    lap("generate_and_mask")

    deduped, dup_stats = clean.deduplicate(raw)
    deduped = cut_lineage(deduped)
    clean.check_contract(deduped, required=[spec.date_col], date_cols=[spec.date_col])
    metrics, ranked, recs, summary = benchmark(complete, spec, methods=methods,
                                               benchmark_rows=benchmark_rows)
    policy = {r["feature"]: r["method"] for r in recs.collect()}   # one row per feature
    repaired = cut_lineage(repair_with_policy(deduped, spec, policy))
    lap("benchmark_and_repair")

    num = list(spec.numeric)
    iqr = outliers.iqr_summary(repaired, num)
    flags = outliers.isolation_forest_flags(repaired, key, num)
    engineered = features.calendar_features(repaired, spec.date_col)
    engineered = features.temporal_features(engineered, spec, num[0])
    engineered = clean.min_max_normalize(engineered, num)
    engineered = cut_lineage(engineered.join(flags.select(*key, "IsolationForest_Outlier"), key))
    lap("outliers_features")

    target = num[0]
    results = stats.normality_tests(engineered, target, key)
    results = results.unionByName(stats.correlation_tests(engineered, num[1:], target))
    if spec.group_keys:
        results = results.unionByName(stats.anova(engineered, target, spec.group_keys[0]))
    results = results.unionByName(stats.chi_square(engineered, spec.categorical[0], label)) \
        if spec.categorical and spec.categorical[0] != label else results
    eda_tables = {"missing_rate": missing_profile(raw),
                  "correlation": eda.correlation_matrix(engineered, num),
                  "histogram": eda.histogram(engineered, target)}
    lap("statistics_eda")

    feats = modeling.Features(num, [c for c in spec.categorical if c != label], label)
    training = selection.train_and_evaluate(engineered, feats, spec.date_col, key, models=models)
    report = evaluate.classification_report(training.test_scored, "actual", "predicted")
    confusion = evaluate.confusion_counts(training.test_scored, "actual", "predicted")
    lap("train_evaluate")

    best = best_method(summary).first()
    payload = {
        "rows_raw": raw.count(), "duplicates_removed": dup_stats.first()["removed"],
        "policy": policy, "best_imputation_method": best["method"] if best else None,
        "best_model": training.model_name, "holdout_metrics": training.metrics,
        "stage_seconds": timings,
    }
    out = {"provenance": provenance, "metrics": metrics, "ranked": ranked,
           "recommendations": recs, "method_summary": summary, "repaired": repaired,
           "iqr": iqr, "engineered": engineered, "statistics": results,
           "model_comparison": training.comparison, "classification_report": report,
           "confusion": confusion, "holdout_predictions": training.test_scored, **eda_tables}
    if out_dir:
        for name, df in out.items():
            write_table(df, f"{out_dir.rstrip('/')}/{name}")
        write_summary(spark, payload, f"{out_dir.rstrip('/')}/summary")
    out["summary"] = payload
    return out


_ = METHODS
