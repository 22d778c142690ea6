"""Risk-classifier training: splits, folds, preprocessing, single fits, persistence.

Leak-safe by default: the preprocessing (median imputation, robust scaling,
mode fill, one-hot) is fitted inside each training fold / on the training
period only, and target-derived columns are never predictors.

* J1 chronological split: the cut row's (date, key) by order-statistic selection, then two
  filters; first int(n * 0.75) rows train.
* J2/J3 CV sample and stratified folds: exact md5 sample, then the fold is the
  md5 position within the class modulo 3 (``rank.positions`` per class).
* ``fit_model`` fits one MLlib estimator (AdaBoost: a SAMME loop of weighted stumps);
  comparing, searching and refitting many fits at once is ``selection``'s.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       GBTClassifier, LinearSVC,
                                       LogisticRegression, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import Imputer, OneHotEncoder, RobustScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import DEFAULT_SEED, md5_key
from ..session import cut_lineage
from .impute import string_modes
from .quantile import exact_quantiles
from .rank import positions

LABEL = "label_idx"


def _as_number(df: DataFrame, col: str):
    """The column as a double of the same order (dates: days, timestamps: microseconds)."""
    kind = df.schema[col].dataType.simpleString()
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


def _order_statistic(df: DataFrame, col: str, rank: int, n: int) -> float:
    """The ``rank``-th smallest (from 1) of ``n`` values, checked by exact counts."""
    v = exact_quantiles(df, [col], [(rank - 1) / max(n - 1, 1)])[col, (rank - 1) / max(n - 1, 1)]
    while True:  # the quantile may fall between two values, or a rank's rounding beside it
        c = F.col(col)
        r = df.agg(F.count_if(c < v).alias("below"), F.count_if(c <= v).alias("upto"),
                   F.max(F.when(c < v, c)).alias("prev"), F.min(F.when(c > v, c)).alias("next")).first()
        if r["below"] < rank <= r["upto"]:
            return v
        v = r["prev"] if rank <= r["below"] else r["next"]


def chronological_split(df: DataFrame, date_col: str, key_cols, test_size: float = 0.25):
    """First int(n * (1 - test_size)) rows by (date, key) train, the rest test.

    The cut is an order statistic of the dates (NULL first) and, among the rows of that date, of the
    keys; the two sides are filters by literals, so no full row is moved.
    """
    key_cols = list(key_cols)
    keys = df.select(*key_cols, _as_number(df, date_col).alias("_date"))
    c = keys.agg(F.count(F.lit(1)).alias("n"), F.count("_date").alias("dated")).first()
    cut = int(c["n"] * (1 - test_size))
    if cut == 0 or cut == c["n"]:
        return df.where(F.lit(cut > 0)), df.where(F.lit(cut == 0))
    undated = c["n"] - c["dated"]
    date = _as_number(df, date_col)
    if cut <= undated:
        at, left, earlier, here = keys.where("_date IS NULL"), cut, F.lit(False), date.isNull()
    else:
        v = _order_statistic(keys.where("_date IS NOT NULL"), "_date", cut - undated, c["dated"])
        at = keys.where(F.col("_date") == v)
        left = cut - undated - keys.where(F.col("_date") < v).count()
        earlier, here = date.isNull() | (date < v), F.coalesce(date == v, F.lit(False))
    last = positions(at.select(*key_cols), [], key_cols, "_pos").where(F.col("_pos") == left).first()
    upto = F.struct(*key_cols) <= F.struct(*[F.lit(last[k]).cast(df.schema[k].dataType).alias(k) for k in key_cols])
    trains = F.coalesce(earlier, F.lit(False)) | (here & upto)
    return df.where(trains), df.where(~trains)


def stratified_folds(df: DataFrame, label: str, key_cols, k: int = 3,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """fold = (md5 position within the class) mod k; every class spread evenly."""
    tagged = df.withColumn("_fh", md5_key(key_cols, seed, "fold"))
    pos = positions(tagged, [label], ["_fh", *key_cols], "_fp")
    return pos.withColumn("fold", (F.col("_fp") % k).cast("int")).drop("_fh", "_fp")


@dataclass
class Features:
    numeric: list
    categorical: list
    label: str


def preprocessing_stages(feats: Features):
    """Median impute + robust scale numerics; index + one-hot categoricals."""
    stages = []
    num_in = list(feats.numeric)
    imp_out = [f"_imp_{c}" for c in num_in]
    if num_in:
        stages.append(Imputer(strategy="median", inputCols=num_in, outputCols=imp_out))
        stages.append(VectorAssembler(inputCols=imp_out, outputCol="_num_vec",
                                      handleInvalid="keep"))
        stages.append(RobustScaler(inputCol="_num_vec", outputCol="_num_scaled",
                                   withCentering=True, withScaling=True))
    cat_idx = [f"_idx_{c}" for c in feats.categorical]
    cat_oh = [f"_oh_{c}" for c in feats.categorical]
    if feats.categorical:
        stages.append(StringIndexer(inputCols=list(feats.categorical), outputCols=cat_idx,
                                    handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=cat_idx, outputCols=cat_oh, handleInvalid="keep",
                                    dropLast=False))
    inputs = (["_num_scaled"] if num_in else []) + cat_oh
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(StringIndexer(inputCol=feats.label, outputCol=LABEL, handleInvalid="skip",
                                stringOrderType="alphabetAsc"))
    return stages


def candidate_models(n_train: int, seed: int = DEFAULT_SEED) -> dict:
    """The comparison set; its parameters are fixed values of the task.

    C=1 logistic regression is regParam = 1 / (C * n).
    """
    return {
        "Logistic Regression": lambda: LogisticRegression(
            featuresCol="features", labelCol=LABEL, maxIter=800, regParam=1.0 / max(n_train, 1),
            elasticNetParam=0.0, standardization=False, family="multinomial"),
        "Decision Tree": lambda: DecisionTreeClassifier(
            featuresCol="features", labelCol=LABEL, maxDepth=12, minInstancesPerNode=4, seed=seed),
        "Random Forest": lambda: RandomForestClassifier(
            featuresCol="features", labelCol=LABEL, numTrees=180, maxDepth=16,
            minInstancesPerNode=2, seed=seed),
        "Gradient Boosting": lambda: OneVsRest(
            featuresCol="features", labelCol=LABEL, parallelism=4,
            classifier=GBTClassifier(maxIter=120, stepSize=0.07, maxDepth=3, seed=seed)),
        "AdaBoost": lambda: SammeBoost(n_estimators=100, learning_rate=0.6, seed=seed),
        "Support Vector Machine": lambda: OneVsRest(
            featuresCol="features", labelCol=LABEL, parallelism=4,
            classifier=LinearSVC(maxIter=100, regParam=1.0 / (1.2 * max(n_train, 1)))),
    }


CUT_ROUNDS = 10
SAMME_TABLE = "samme-weights"
MODEL_TABLE = "model-arrays"  # of selection.FittedModel


class SammeBoost:
    """AdaBoost (SAMME) over weighted depth-1 MLlib trees."""

    def __init__(self, n_estimators=100, learning_rate=0.6, seed=DEFAULT_SEED):
        self.n_estimators, self.lr, self.seed = n_estimators, learning_rate, seed

    def fit(self, df: DataFrame):
        """One tree and one aggregate per round.

        The weights' new total follows from the aggregate (the wrong rows' weight
        grows by e^alpha), so the next round's expression normalises them; lineage is
        cut every ``CUT_ROUNDS`` rounds.
        """
        k = int(df.agg(F.max(LABEL)).first()[0]) + 1
        cur = cut_lineage(df.select("features", LABEL).withColumn("_w", F.lit(1.0)))
        stumps = []
        for i in range(self.n_estimators):
            tree = DecisionTreeClassifier(featuresCol="features", labelCol=LABEL, weightCol="_w",
                                          maxDepth=1, seed=self.seed + i).fit(cur)
            bad = F.col("prediction") != F.col(LABEL)
            pred = tree.transform(cur)
            r = pred.agg(F.sum(F.when(bad, F.col("_w"))).alias("e"), F.sum("_w").alias("t")).first()
            wrong, total = r["e"] or 0.0, r["t"]
            err = wrong / total
            if err <= 0:
                stumps.append((tree, 1.0))
                break
            if err >= 1.0 - 1.0 / k:
                break
            alpha = self.lr * (math.log((1 - err) / err) + math.log(k - 1))
            stumps.append((tree, alpha))
            grown = total + wrong * (math.exp(alpha) - 1.0)
            cur = pred.select("features", LABEL, (F.when(bad, F.col("_w") * math.exp(alpha))
                                                  .otherwise(F.col("_w")) / F.lit(grown)).alias("_w"))
            if (i + 1) % CUT_ROUNDS == 0:
                cur = cut_lineage(cur)
        return SammeModel(stumps, k)


class SammeModel:
    def __init__(self, stumps, k):
        self.stumps, self.k = stumps, k

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("_votes", F.array(*[F.lit(0.0)] * self.k))
        for i, (tree, alpha) in enumerate(self.stumps):
            out = tree.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}") \
                .setProbabilityCol(f"_q{i}").transform(out)
            out = out.withColumn("_votes", F.transform(
                "_votes", lambda v, j: v + F.when(F.col(f"_p{i}") == j, F.lit(alpha))
                .otherwise(F.lit(0.0)))).drop(f"_p{i}", f"_r{i}", f"_q{i}")
        best = F.array_position(F.col("_votes"), F.array_max("_votes")) - 1
        total = sum(a for _, a in self.stumps) or 1.0
        return (out.withColumn("prediction", best.cast("double"))
                .withColumn("max_vote", F.array_max("_votes") / F.lit(total)).drop("_votes"))

    def save(self, path: str, pre: PipelineModel) -> None:
        """Preprocessing, stumps and a table of their weights below ``path``."""
        spark = SparkSession.getActiveSession()
        pre.write().overwrite().save(f"{path}/pre")
        for i, (tree, _) in enumerate(self.stumps):
            tree.write().overwrite().save(f"{path}/stump-{i}")
        spark.createDataFrame([(i, float(a), self.k) for i, (_, a) in enumerate(self.stumps)],
                              "stump int, alpha double, classes int").write.mode(
            "overwrite").parquet(f"{path}/{SAMME_TABLE}")

    @classmethod
    def load(cls, path: str) -> _Chain:
        rows = SparkSession.getActiveSession().read.parquet(f"{path}/{SAMME_TABLE}").orderBy(
            "stump").collect()  # one row per boosting round
        stumps = [(DecisionTreeClassificationModel.load(f"{path}/stump-{r['stump']}"), r["alpha"])
                  for r in rows]
        return _Chain(PipelineModel.load(f"{path}/pre"), cls(stumps, rows[0]["classes"] if rows else 1))


def fit_model(name: str, train: DataFrame, feats: Features, n_train: int, seed=DEFAULT_SEED,
              params: dict | None = None):
    """Fit preprocessing on ``train`` and the named model; returns a scorer with transform().

    ``params`` overrides model parameters (``C`` maps to regParam = 1 / (C * n)).
    """
    pre = Pipeline(stages=preprocessing_stages(feats)).fit(train)
    tr = pre.transform(train)
    est = candidate_models(n_train, seed)[name]()
    if params:
        p = dict(params)
        if "C" in p:
            p["regParam"] = 1.0 / (p.pop("C") * max(n_train, 1))
        est = est.copy(extra={est.getParam(k): v for k, v in p.items()})
    if isinstance(est, SammeBoost):
        model = est.fit(tr)
        return _Chain(pre, model)
    return _Chain(pre, est.fit(tr))


class _Chain:
    def __init__(self, pre: PipelineModel, model):
        self.pre, self.model = pre, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.pre.transform(df))

    def labels(self) -> list:
        return list(self.pre.stages[-1].labels)


def _scored(chain: _Chain, df: DataFrame) -> DataFrame:
    labels = chain.labels()
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    return chain.transform(df).select(F.col(LABEL).cast("int").alias("_y"),
                                      lab.alias("predicted"),
                                      F.element_at(F.array(*[F.lit(x) for x in labels]),
                                                   F.col(LABEL).cast("int") + 1).alias("actual"))


def save_model(chain, path: str) -> None:
    """Persist preprocessing + model as one MLlib ``PipelineModel`` (other models: their parts)."""
    if hasattr(chain.model, "save") and not hasattr(chain.model, "uid"):
        chain.model.save(path, chain.pre)
        return
    PipelineModel(stages=list(chain.pre.stages) + [chain.model]).write().overwrite().save(path)


def score_batch(model_path: str, df: DataFrame) -> DataFrame:
    """Load a saved pipeline and score every row: class and max class probability."""
    from pyspark.errors import AnalysisException
    from pyspark.ml.functions import vector_to_array

    def has(table):
        try:
            df.sparkSession.read.parquet(f"{model_path}/{table}")
        except AnalysisException:
            return False
        return True

    if has(SAMME_TABLE):
        return SammeModel.load(model_path).transform(df).withColumnRenamed(
            "max_vote", "max_probability")
    if has(MODEL_TABLE):
        from .selection import FittedModel
        out = FittedModel.load(model_path).transform(df)
    else:  # one pipeline
        out = PipelineModel.load(model_path).transform(df)
    if "probability" not in out.columns:  # one-vs-rest margins are no probabilities
        return out.withColumn("max_probability", F.lit(None).cast("double"))
    return out.withColumn("max_probability", F.array_max(vector_to_array("probability")))


def fill_modes(train: DataFrame, cols) -> dict:
    """Train-period modes of the categoricals (D13 fitted on train only)."""
    return string_modes(train, cols)
