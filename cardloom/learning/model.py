"""Fraud classifier: split, training, evaluation, storage, scoring."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cardloom.learning.features import CATEGORICAL, FEATURES, NUMERIC, request_features
from cardloom.learning.forest import Forest, Grown, votes_of
from cardloom.operators.indicators import risk_level

# Fixed values of the model.
VERSION = "1.0.0"
TYPE = "RandomForestClassifier"
SEED = 42
TRAIN_SHARE = (4, 5)
MIN_ROWS = 100
HYPERPARAMETERS = {
    "n_estimators": 100, "max_depth": 12, "min_samples_split": 10, "min_samples_leaf": 5,
    "class_weight": "balanced", "random_state": SEED,
}
HASH_BITS = 20
ROWS_PER_PART = 1_000_000
SETTINGS_AT_ONCE = 4


def split(rows: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Exact stratified 80/20 split: per label, the rows with the smallest
    round-down(0.8 n) hashes train.

    A rank over a whole label would put it into one task. The hash is cut into
    2^20 slices, and slices are counted; only the one slice per label in which
    the border falls is ranked, to find the border row. Each row is then told
    apart by comparing it with the border of its label (one row per label).
    """
    keyed = rows.withColumn("_h", F.xxhash64("id_transaction", F.lit(seed))).withColumn(
        "_slice", F.shiftrightunsigned("_h", 64 - HASH_BITS).cast("int")
    )
    upto = Window.partitionBy("label").orderBy("_slice")
    edge = (
        keyed.groupBy("label", "_slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_upto", F.sum("n").over(upto))
        .withColumn("_k", F.expr(f"sum(n) OVER (PARTITION BY label) * {TRAIN_SHARE[0]} div {TRAIN_SHARE[1]}"))
        .where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("n") < F.col("_k")))
        .select("label", "_slice", (F.col("_k") - F.col("_upto") + F.col("n")).alias("_take"))
    )
    rank = F.row_number().over(Window.partitionBy("label", "_slice").orderBy("_h", "id_transaction"))
    borders = (
        keyed.select("label", "_slice", "_h", "id_transaction")
        .join(F.broadcast(edge), ["label", "_slice"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_take"))
        .select("label", "_slice", "_h", "id_transaction")
        .collect()
    )
    # one row per label: told as literals, so that reading a side does not look for the borders again
    place = F.struct("_slice", "_h", "id_transaction")
    trains = F.lit(False)
    for b in borders:
        border = F.struct(*[F.lit(b[c]).cast(keyed.schema[c].dataType).alias(c) for c in ("_slice", "_h", "id_transaction")])
        trains = F.when(F.col("label") == b["label"], place <= border).otherwise(trains)
    return keyed.where(trains).select(*rows.columns), keyed.where(~trains).select(*rows.columns)


def class_counts(rows: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def balanced(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds ``weight`` = n / (classes x rows of the class)."""
    n = sum(counts.values())
    weight = F.lit(None).cast("double")
    for label, size in counts.items():
        weight = F.when(F.col("label") == label, n / (len(counts) * size)).otherwise(weight)
    return rows.withColumn("weight", weight)


def forest(trees: int = HYPERPARAMETERS["n_estimators"], depth: int = HYPERPARAMETERS["max_depth"]):
    """At least 5 rows per leaf, hence at least 10 per split node."""
    return Forest(RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=HYPERPARAMETERS["min_samples_leaf"], maxBins=64, seed=SEED,
    ))


def encoder(train: DataFrame) -> list:
    """Fitted stages that give ``features``: scaled numbers, then category codes.

    Codes follow the alphabet; a value unseen in training gets -1. Rewriting the
    code also drops its nominal metadata, so the trees treat it as an ordinal.
    """
    indexer = StringIndexer(
        inputCols=list(CATEGORICAL), outputCols=[f"_{c}" for c in CATEGORICAL],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    ).fit(train)
    codes = ", ".join(
        f"IF(_{c} >= {len(values)}, -1.0D, _{c} + 0.0D) AS {c}_code"
        for c, values in zip(CATEGORICAL, indexer.labelsArray)
    )
    coder = SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")
    numbers = VectorAssembler(inputCols=list(NUMERIC), outputCol="_numbers")
    scaler = StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True).fit(
        numbers.transform(train)
    )
    joined = VectorAssembler(inputCols=["_scaled", *[f"{c}_code" for c in CATEGORICAL]], outputCol="features")
    return [indexer, coder, numbers, scaler, joined]


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """Rows dealt by a hash of themselves into a number of parts that follows from
    their number ``n``, in a fixed order within each part. Trees draw their rows by
    part, so the same rows give the same forest on any number of cores."""
    parts = max(8, -(-n // ROWS_PER_PART))
    by = [c for c in ("id_transaction", *FEATURES) if c in rows.columns]
    return rows.repartition(parts, *by).sortWithinPartitions(*by)


def encoded(train: DataFrame) -> tuple[list, DataFrame]:
    """Fitted encoder, and the training rows as a classifier takes them, classes balanced.

    The rows are dealt once, and those that come back are stored, for the encoder's
    passes and the classifier's: unpersist them in the end."""
    counts = class_counts(train)
    ready = _dealt(train, sum(counts.values())).persist()
    stages = encoder(ready)
    made = PipelineModel(stages).transform(balanced(ready, counts)).select("features", "label", "weight").persist()
    made.count()
    ready.unpersist()
    return stages, made


def fit(train: DataFrame, classifier=None) -> PipelineModel:
    """Encoder and classifier fitted on the training rows, classes balanced."""
    stages, ready = encoded(train)
    try:
        fitted = (classifier or forest()).fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([*stages, fitted])


def evaluate(model: PipelineModel, test: DataFrame) -> dict[str, Any]:
    """Metrics of a model on test rows."""
    return evaluate_scores(model.transform(test).select("label", "prediction", "rawPrediction"))


def areas(scored: DataFrame, *metrics: str) -> list[float]:
    """Areas under curves of (label, rawPrediction), ``areaUnderROC`` or ``areaUnderPR``; the scores are sorted and
    counted once for all of them."""
    # 0 bins: the curves are not thinned out
    evaluator = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    evaluator._transfer_params_to_java()
    found = evaluator._java_obj.getMetrics(scored._jdf)
    try:
        return [getattr(found, metric)() for metric in metrics]
    finally:
        found.unpersist()


def evaluate_grown(grown: Grown, held: DataFrame) -> dict[str, Any]:
    """Metrics of a forest on encoded rows, those of its model."""
    votes = F.col("votes")[0]
    # of equal votes the first label's count
    return evaluate_scores(grown.scores(held).select(
        "label", (votes[1] > votes[0]).cast("double").alias("prediction"), votes[1].alias("rawPrediction")
    ))


def evaluate_scores(rows: DataFrame) -> dict[str, Any]:
    """ROC-AUC and PR-AUC over every distinct score, precision, recall, F1 (0 when
    undefined), confusion matrix, counts, from (label, prediction, rawPrediction);
    rawPrediction is a score or a vector of them."""
    scored = rows.persist()
    try:
        cells = {
            (r["label"], int(r["prediction"])): r["n"]
            for r in scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        roc, pr = areas(scored, "areaUnderROC", "areaUnderPR")
    finally:
        scored.unpersist()
    tn, fp, fn, tp = (cells.get(c, 0) for c in ((0, 0), (0, 1), (1, 0), (1, 1)))
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    return {
        "roc_auc": roc,
        "pr_auc": pr,
        "precision_fraud": precision,
        "recall_fraud": recall,
        "f1_fraud": 2 * precision * recall / (precision + recall) if precision + recall else 0.0,
        "n_test": tn + fp + fn + tp,
        "n_fraud_test": fn + tp,
        "confusion_matrix": {
            "true_negative": tn, "false_positive": fp, "false_negative": fn, "true_positive": tp,
        },
    }


def train_and_evaluate(rows: DataFrame, classifier=None) -> tuple[PipelineModel, dict[str, Any]]:
    """Split, fit, evaluate. ``rows`` is read several times: pass a stored table."""
    n = sum(class_counts(rows).values())
    if n < MIN_ROWS:
        raise ValueError(f"at least {MIN_ROWS} labelled rows are needed, not {n}")
    train, test = split(rows)
    learner = classifier or forest()
    if not isinstance(learner, Forest):
        model = fit(train, learner)
        return model, evaluate(model, test)
    stages, ready = encoded(train)
    try:
        grown = learner.grown(ready)
    finally:
        ready.unpersist()
    return PipelineModel([*stages, grown.model()]), evaluate_grown(grown, PipelineModel(stages).transform(test))


def save(model: PipelineModel, metrics: dict[str, Any], folder: str) -> None:
    """Model and its metadata, both below ``folder``."""
    model.write().overwrite().save(f"{folder}/model")
    metadata = {
        "model_version": VERSION,
        "model_type": TYPE,
        "trained_at": datetime.now(timezone.utc).isoformat(),
        "feature_columns": list(FEATURES),
        "numerical_features": list(NUMERIC),
        "categorical_features": list(CATEGORICAL),
        "metrics": metrics,
        "hyperparameters": HYPERPARAMETERS,
    }
    spark = SparkSession.active()
    one = spark.createDataFrame([(json.dumps(metadata),)], "value string")
    one.coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")


def load(folder: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/model")


def info(spark: SparkSession, folder: str) -> DataFrame:
    """One row about a stored model."""
    return spark.read.text(f"{folder}/metadata").select(
        F.lit(True).alias("is_loaded"),
        F.get_json_object("value", "$.model_version").alias("model_version"),
        F.get_json_object("value", "$.model_type").alias("model_type"),
        F.get_json_object("value", "$.metrics").alias("metrics"),
        F.get_json_object("value", "$.feature_columns").alias("feature_columns"),
    )


def _predicted(model: PipelineModel, rows: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Rows with whether fraud is predicted and its probability. A forest's votes are counted in arrays: its own
    transform walks a row through the trees for itself, which takes over ten times as long."""
    *stages, last = model.stages
    votes = votes_of(last, vector_to_array(last.getFeaturesCol())) if isinstance(last, RandomForestClassificationModel) else None
    if votes is None:
        return model.transform(rows), F.col("prediction") == 1.0, vector_to_array("probability")[1]
    voted = PipelineModel(stages).transform(rows).withColumn("_votes", votes)
    no, yes = F.col("_votes.no"), F.col("_votes.yes")
    # of equal votes the first label's count
    return voted, yes > no, F.when(no + yes != 0, yes / (no + yes)).otherwise(yes)


def score(model: PipelineModel, requests: DataFrame, *keep: str, at: Column | None = None) -> DataFrame:
    """Scores a table or a stream of requests."""
    rows, predicted, p = _predicted(model, request_features(requests, *keep))
    return rows.select(
        *keep,
        predicted.alias("is_fraud_predicted"),
        F.round(p, 4).alias("fraud_probability"),
        risk_level(p).alias("risk_level"),
        F.lit(VERSION).alias("model_version"),
        F.lit(TYPE).alias("model_type"),
        (F.current_timestamp() if at is None else at).alias("predicted_at"),
        F.struct(*FEATURES).alias("features_used"),
    )


def given_logistic(spark: SparkSession, weights: dict[str, float], intercept: float) -> PipelineModel:
    """Logistic model with given weights of the numeric features, in the form that ``score`` takes."""
    linear = " + ".join([repr(intercept), *(f"{w!r} * {name}" for name, w in weights.items())])
    p = f"1 / (1 + exp(-({linear})))"
    probability = SQLTransformer(statement=f"SELECT *, {p} AS _p FROM __THIS__")
    vector = SQLTransformer(statement="SELECT *, 1 - _p AS _q, IF(_p > 0.5, 1.0D, 0.0D) AS prediction FROM __THIS__")
    return PipelineModel([probability, vector, VectorAssembler(inputCols=["_q", "_p"], outputCol="probability")])


def fold_of(folds: int) -> Column:
    """Fold of a row, by a hash of its id."""
    return F.pmod(F.xxhash64("id_transaction", F.lit(SEED)), F.lit(folds)).cast("int")


def cross_validate(rows: DataFrame, trees: list[int], depths: list[int], folds: int = 3) -> list[dict[str, Any]]:
    """Mean area under the precision-recall curve per setting, over the folds.

    Encoder, scaling and class weights are fitted on the rows outside the fold
    only, once a fold. One forest of the most trees and levels is grown a fold; the
    settings are cuts of it and get their scores by one pass over the fold. ``rows``
    is read several times per fold: pass a stored table.
    """
    settings = [(n, depth) for n in trees for depth in depths]
    by_setting: dict[tuple[int, int], list[float]] = {s: [] for s in settings}
    for k in range(folds):
        stages, ready = encoded(rows.where(fold_of(folds) != k))
        try:
            grown = forest(max(trees), max(depths)).grown(ready)
        finally:
            ready.unpersist()
        held = PipelineModel(stages).transform(rows.where(fold_of(folds) == k))
        scored = grown.scores(held, settings).persist()
        try:
            # filled by one job, before jobs side by side would fill it twice
            scored.count()
            found = _side_by_side(
                rows.sparkSession,
                lambda i: areas(scored.select("label", F.col("votes")[i][1].alias("rawPrediction")), "areaUnderPR")[0],  # noqa: B023
                range(len(settings)),
            )
        finally:
            scored.unpersist()
        for setting, value in zip(settings, found):
            by_setting[setting].append(value)
    return [{"numTrees": n, "maxDepth": depth, "pr_auc": sum(by_setting[n, depth]) / folds} for n, depth in settings]


def _side_by_side(spark: SparkSession, what: Callable, items) -> list:
    with ThreadPoolExecutor(SETTINGS_AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(spark)(what), items))


def compare(rows: DataFrame, trees: int = HYPERPARAMETERS["n_estimators"]) -> dict[str, dict[str, Any]]:
    """Metrics of three classifiers on the same split."""
    columns = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    learners = {
        "LogisticRegression": LogisticRegression(maxIter=100, **columns),
        "RandomForestClassifier": forest(trees),
        "GBTClassifier": GBTClassifier(maxIter=20, maxDepth=5, maxBins=64, seed=SEED, **columns),
    }
    train, test = split(rows)
    # the learners share the encoded rows and run side by side
    stages, ready = encoded(train)
    held = PipelineModel(stages).transform(test).select("features", "label").persist()

    def metrics(learner) -> dict[str, Any]:
        if isinstance(learner, Forest):
            return evaluate_grown(learner.grown(ready), held)
        return evaluate(PipelineModel([learner.fit(ready)]), held)

    try:
        # filled by one job, before jobs side by side would fill it twice
        held.count()
        return dict(zip(learners, _side_by_side(rows.sparkSession, metrics, learners.values())))
    finally:
        held.unpersist()
        ready.unpersist()
