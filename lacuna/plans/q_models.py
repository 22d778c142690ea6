"""Evaluation queries (J15, K1-K5) on the scored ``labels`` table, and model queries.

``scored_labels``: actual = quality, predicted = toxic (a fixed (actual,
predicted) table); the score for curves is the document length min-max scaled
over the labelled documents (any numeric score works).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate
from ..session import cut_lineage
from ..operators.clean import min_max_normalize
from ..sources.tables import SCORED_LABELS_SQL, read_table, scored_labels
from .catalog import query

SL = f"WITH sl AS ({SCORED_LABELS_SQL})"
SCORED_SQL = f"""WITH j AS (SELECT l.doc_id, CAST(l.quality AS VARCHAR) AS actual,
                          CAST(l.toxic AS VARCHAR) AS predicted, CAST(d.n_chars AS DOUBLE) AS n_chars
                   FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
sc AS (SELECT doc_id, actual, predicted,
              CASE WHEN max(n_chars) OVER () = min(n_chars) OVER () THEN 0.0
                   ELSE (n_chars - min(n_chars) OVER ()) / (max(n_chars) OVER ()
                        - min(n_chars) OVER ()) END AS score FROM j)"""


def _scored(spark, sf_dir) -> DataFrame:
    lab = scored_labels(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    j = lab.join(docs, "doc_id")
    return min_max_normalize(j, ["n_chars"]).withColumnRenamed("n_chars_Normalized", "score")


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


_PC = SL + """,
c AS (SELECT actual, predicted, count(*) AS n FROM sl GROUP BY 1, 2),
labels_ AS (SELECT actual AS label FROM c UNION SELECT predicted FROM c),
pc0 AS (SELECT l.label,
   coalesce((SELECT sum(n) FROM c WHERE c.actual = l.label AND c.predicted = l.label), 0) AS tp,
   coalesce((SELECT sum(n) FROM c WHERE c.actual = l.label), 0) AS support,
   coalesce((SELECT sum(n) FROM c WHERE c.predicted = l.label), 0) AS npred
  FROM labels_ l),
pc1 AS (SELECT label, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
               CAST(support AS DOUBLE) AS support FROM pc0),
pc AS (SELECT label, precision, recall,
              CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                   ELSE 0.0 END AS "f1-score", support FROM pc1)"""


@query("j15_classification_metrics", _PC + """
SELECT round((SELECT count_if(actual = predicted) / count(*) FROM sl), 6) AS accuracy,
       round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
       round(avg("f1-score"), 6) AS f1_macro FROM pc""")
def j15_classification_metrics(spark, sf_dir):
    m = evaluate.summary_metrics(scored_labels(spark, sf_dir), "actual", "predicted")
    return m.select(*[_r(c) for c in ("accuracy", "precision_macro", "recall_macro", "f1_macro")])


@query("k1_classification_report", _PC + """,
acc AS (SELECT count_if(actual = predicted) / count(*) AS a FROM sl)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round("f1-score", 6) AS "f1-score", round(support, 6) AS support FROM (
  SELECT * FROM pc
  UNION ALL SELECT 'accuracy', a, a, a, a FROM acc
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg("f1-score"), sum(support) FROM pc
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
     sum(recall * support) / sum(support), sum("f1-score" * support) / sum(support),
     sum(support) FROM pc)""")
def k1_classification_report(spark, sf_dir):
    r = evaluate.classification_report(scored_labels(spark, sf_dir), "actual", "predicted")
    return r.select("label", *[_r(c) for c in ("precision", "recall", "f1-score", "support")])


@query("k2_confusion_matrix", SL + """
SELECT actual, predicted, CAST(count(*) AS BIGINT) AS count FROM sl GROUP BY 1, 2""")
def k2_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_counts(scored_labels(spark, sf_dir), "actual", "predicted")


_ROC = SCORED_SQL + """,
bc AS (SELECT score, sum(CASE WHEN actual = '1' THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN actual = '1' THEN 0 ELSE 1 END) AS fp FROM sc GROUP BY score),
tot AS (SELECT sum(tp) AS P, sum(fp) AS N FROM bc),
cum AS (SELECT score, tp, fp,
   sum(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tp,
   sum(fp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_fp
   FROM bc)"""


@query("k3_k4_roc_pr_points", _ROC + """
SELECT round(score, 6) AS threshold, CAST(cum_tp AS BIGINT) AS cum_tp,
       CAST(cum_fp AS BIGINT) AS cum_fp, round(cum_tp / P, 6) AS tpr, round(cum_fp / N, 6) AS fpr,
       round(cum_tp / (cum_tp + cum_fp), 6) AS precision
FROM cum, tot""")
def k3_k4_roc_pr_points(spark, sf_dir):
    p = evaluate.roc_pr_points(_scored(spark, sf_dir), "actual", "score", positive="1")
    return p.select(_r("threshold"), F.col("cum_tp").cast("long").alias("cum_tp"),
                    F.col("cum_fp").cast("long").alias("cum_fp"), _r("tpr"), _r("fpr"),
                    _r("precision"))


@query("k3_k4_auc_ap", _ROC + """
SELECT round(sum(fp / N * (2 * cum_tp - tp) / (2 * P)), 6) AS roc_auc,
       round(sum(tp / P * cum_tp / (cum_tp + cum_fp)), 6) AS average_precision
FROM cum, tot""")
def k3_k4_auc_ap(spark, sf_dir):
    p = evaluate.roc_pr_points(_scored(spark, sf_dir), "actual", "score", positive="1")
    return evaluate.auc_ap(p).select(_r("roc_auc"), _r("average_precision"))


@query("k5_calibration", SCORED_SQL + """,
e AS (SELECT quantile_cont(score, 0.125) AS q1, quantile_cont(score, 0.25) AS q2,
             quantile_cont(score, 0.375) AS q3, quantile_cont(score, 0.5) AS q4,
             quantile_cont(score, 0.625) AS q5, quantile_cont(score, 0.75) AS q6,
             quantile_cont(score, 0.875) AS q7 FROM sc),
b AS (SELECT score, CASE WHEN actual = '1' THEN 1.0 ELSE 0.0 END AS y,
        (CASE WHEN score > q1 THEN 1 ELSE 0 END) + (CASE WHEN score > q2 THEN 1 ELSE 0 END)
      + (CASE WHEN score > q3 THEN 1 ELSE 0 END) + (CASE WHEN score > q4 THEN 1 ELSE 0 END)
      + (CASE WHEN score > q5 THEN 1 ELSE 0 END) + (CASE WHEN score > q6 THEN 1 ELSE 0 END)
      + (CASE WHEN score > q7 THEN 1 ELSE 0 END) AS bin FROM sc, e)
SELECT bin, round(avg(score), 6) AS mean_predicted, round(avg(y), 6) AS observed_frequency,
       CAST(count(*) AS BIGINT) AS n FROM b GROUP BY bin""")
def k5_calibration(spark, sf_dir):
    c = evaluate.calibration(_scored(spark, sf_dir), "actual", "score", positive="1")
    return c.select("bin", _r("mean_predicted"), _r("observed_frequency"), "n")


# ---------------------------------------------------------------- modelling (J, E8, K6-K11)
from ..operators import explain, modeling, selection  # noqa: E402
from ..sources.tables import ORDER_FACTS_SQL, order_facts  # noqa: E402
from .fixtures_sql import md5_sql  # noqa: E402

FEATS = modeling.Features(["o_totalprice", "qty", "extprice", "n_lines", "avg_disc"],
                          ["o_orderpriority", "c_mktsegment"], "o_orderstatus")
KEY = ["o_orderkey"]

@query("j1_chronological_split", f"""WITH of AS ({ORDER_FACTS_SQL})
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
                         <= CAST(floor(count(*) OVER () * 0.75) AS BIGINT)
                   THEN 'train' ELSE 'test' END AS split
FROM of""")
def j1_chronological_split(spark, sf_dir):
    train, test = modeling.chronological_split(order_facts(spark, sf_dir), "o_orderdate", KEY)
    return train.select("o_orderkey", F.lit("train").alias("split")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("split")))


@query("j2_j3_cv_folds", f"""WITH of AS ({ORDER_FACTS_SQL}),
cv AS (SELECT * FROM of ORDER BY {md5_sql(KEY, 'cv')} LIMIT 5000)
SELECT o_orderkey, o_orderstatus,
       CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5_sql(KEY, 'fold')},
            o_orderkey) % 3 AS INTEGER) AS fold
FROM cv""")
def j2_j3_cv_folds(spark, sf_dir):
    from ..operators.missing import sample_rows
    cv = sample_rows(order_facts(spark, sf_dir), KEY, 5000, salt="cv")
    return modeling.stratified_folds(cv, "o_orderstatus", KEY).select(
        "o_orderkey", "o_orderstatus", "fold")


def _training(spark, sf_dir):
    return selection.train_and_evaluate(order_facts(spark, sf_dir), FEATS, "o_orderdate", KEY)


@query("j11_model_comparison")
def j11_model_comparison(spark, sf_dir):
    """CV comparison of the six candidates on the training period (3 stratified folds)."""
    train, _test = modeling.chronological_split(order_facts(spark, sf_dir), "o_orderdate", KEY)
    return selection.cross_validate(cut_lineage(train), FEATS, KEY)


@query("j12_j15_holdout_metrics")
def j12_j15_holdout_metrics(spark, sf_dir):
    """Best model by CV macro F1, refitted on the training period, scored on the holdout."""
    r = _training(spark, sf_dir)
    return spark.createDataFrame([(r.model_name, r.metrics["accuracy"], r.metrics["precision_macro"],
                                   r.metrics["recall_macro"], r.metrics["f1_macro"])],
                                 "model string, accuracy double, precision_macro double, "
                                 "recall_macro double, f1_macro double")


@query("k1_holdout_report")
def k1_holdout_report(spark, sf_dir):
    """Classification report of the selected model's holdout predictions (A8 export rows)."""
    r = _training(spark, sf_dir)
    return evaluate.classification_report(r.test_scored, "actual", "predicted")


def _tuned(spark, sf_dir, model):
    from ..operators.missing import sample_rows
    cv = sample_rows(order_facts(spark, sf_dir), KEY, 5000, salt="cv")
    return selection.tune(model, cv, FEATS, KEY)[1]


@query("j13_tuning")
def j13_tuning(spark, sf_dir):
    """Grid search over tree depth by CV macro F1 on the CV sample."""
    return _tuned(spark, sf_dir, "Decision Tree")


@query("j13_tuning_forest")
def j13_tuning_forest(spark, sf_dir):
    """Random search of five forests' settings by CV macro F1, every tree grown."""
    return _tuned(spark, sf_dir, "Random Forest")


@query("j13_tuning_logistic")
def j13_tuning_logistic(spark, sf_dir):
    """Grid search over C of the logistic regression on the CV sample."""
    return _tuned(spark, sf_dir, "Logistic Regression")


def _tree(spark, sf_dir, facts=None):
    """A tree of the training period and both periods; those of checkpointed ``facts`` are not cut again."""
    train, test = modeling.chronological_split(
        order_facts(spark, sf_dir) if facts is None else facts, "o_orderdate", KEY)
    if facts is None:
        train, test = cut_lineage(train), cut_lineage(test)
    return modeling.fit_model("Decision Tree", train, FEATS, train.count()), train, test


def _curve_rows(spark, sf_dir):
    """The training period, of a panel that is built once: the split reads its dates and keys many times."""
    return _tree(spark, sf_dir, cut_lineage(order_facts(spark, sf_dir)))[1]


@query("k6_learning_curve")
def k6_learning_curve(spark, sf_dir):
    return explain.learning_curve(_curve_rows(spark, sf_dir), FEATS, KEY)


@query("k7_validation_curve")
def k7_validation_curve(spark, sf_dir):
    return explain.validation_curve(_curve_rows(spark, sf_dir), FEATS, KEY)


@query("k8_permutation_importance")
def k8_permutation_importance(spark, sf_dir):
    chain, _tr, test = _tree(spark, sf_dir)
    return explain.permutation_importance(chain, test, FEATS, KEY)


@query("k9_top_importances")
def k9_top_importances(spark, sf_dir):
    return explain.top_importances(k8_permutation_importance(spark, sf_dir))


@query("k10_partial_dependence")
def k10_partial_dependence(spark, sf_dir):
    chain, _tr, test = _tree(spark, sf_dir)
    return explain.partial_dependence(chain, test, FEATS, KEY, positive="F")


@query("k11_tree_importances")
def k11_tree_importances(spark, sf_dir):
    chain, _tr, _te = _tree(spark, sf_dir)
    return explain.tree_importances(chain, FEATS)


@query("e8_downstream_accuracy")
def e8_downstream_accuracy(spark, sf_dir):
    """Logistic-regression accuracy on a repaired (median-filled) masked order_facts."""
    from ..operators.impute import impute
    from ..spec import ORDER_FACTS
    from .panels import masked_order_facts
    rep = impute(masked_order_facts(spark, sf_dir), ORDER_FACTS.with_numeric(FEATS.numeric), "Median")
    acc = selection.downstream_accuracy(rep, FEATS, KEY)
    return spark.createDataFrame([("Median", acc)], "method string, downstream_model_accuracy double")


@query("a6_a8_batch_scoring")
def a6_a8_batch_scoring(spark, sf_dir):
    """Fit on the training period, persist (A7), reload and score every row."""
    from .q_clean import _scratch
    train, _test = modeling.chronological_split(order_facts(spark, sf_dir), "o_orderdate", KEY)
    train = cut_lineage(train)
    chain = modeling.fit_model("Logistic Regression", train, FEATS, train.count())
    path = _scratch(spark, "model")
    modeling.save_model(chain, path)
    scored = modeling.score_batch(path, order_facts(spark, sf_dir))
    labels = chain.labels()
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    return scored.select("o_orderkey", F.col("o_orderstatus").alias("actual"),
                         lab.alias("predicted"), F.round("max_probability", 6).alias("max_probability"))


@query("a8_holdout_rows", f"""WITH of AS ({ORDER_FACTS_SQL}),
s AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS i, count(*) OVER () AS n
      FROM of)
SELECT o_orderkey, o_orderstatus AS actual, round(o_totalprice, 6) AS o_totalprice,
       round(qty, 6) AS qty, round(extprice, 6) AS extprice,
       CAST(n_lines AS DOUBLE) AS n_lines, round(avg_disc, 6) AS avg_disc,
       o_orderpriority, c_mktsegment
FROM s WHERE i > CAST(floor(n * 0.75) AS BIGINT)""")
def a8_holdout_rows(spark, sf_dir):
    """The rows of the holdout export: its features and the actual class."""
    _train, test = modeling.chronological_split(order_facts(spark, sf_dir), "o_orderdate", KEY)
    return test.select("o_orderkey", F.col("o_orderstatus").alias("actual"),
                       *[F.round(c, 6).alias(c) for c in ("o_totalprice", "qty", "extprice")],
                       F.col("n_lines").cast("double").alias("n_lines"),
                       F.round("avg_disc", 6).alias("avg_disc"), *FEATS.categorical)


@query("a8_holdout_predictions")
def a8_holdout_predictions(spark, sf_dir):
    """The holdout export: features, actual and predicted class of the holdout rows alone."""
    train, test = modeling.chronological_split(order_facts(spark, sf_dir), "o_orderdate", KEY)
    train = cut_lineage(train)
    chain = modeling.fit_model("Logistic Regression", train, FEATS, train.count())
    names = F.array(*[F.lit(x) for x in chain.labels()])
    return chain.transform(test).select(
        "o_orderkey", *FEATS.numeric, *FEATS.categorical, F.col("o_orderstatus").alias("actual"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"))


@query("e_full_benchmark")
def e_full_benchmark(spark, sf_dir):
    """All twelve methods on the whole masked order_facts panel, with wall time per
    method (E7) and downstream logistic-regression accuracy (E8) in the composite."""
    from ..operators.scoring import benchmark
    from ..spec import ORDER_FACTS
    df = order_facts(spark, sf_dir)
    spec = ORDER_FACTS.with_numeric(FEATS.numeric)
    metrics, _ranked, rec, _summary = benchmark(
        df, spec, timed=True,
        downstream=lambda reps: selection.downstream_accuracies(reps, FEATS, KEY))
    return metrics.join(rec.select("feature", F.col("method").alias("recommended")), "feature")
