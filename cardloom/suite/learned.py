"""Features, split, training, scoring, drift."""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions.clean import moment
from cardloom.learning import drift, features, model
from cardloom.operators import listing, quality
from cardloom.session import INITIAL_PARTITIONS
from cardloom.sources import tables
from cardloom.suite import landing
from cardloom.suite.base import Model, money_sql, query
from cardloom.suite.relational import _REQUEST_SQL, _VALID_SQL

_AGE = "CAST(CASE WHEN current_age = 0 THEN 45 ELSE coalesce(current_age, 45) END AS DOUBLE)"
_FEATURES_SQL = f"""id_transaction, {money_sql('cents')} AS amount, use_chip, code_mcc AS mcc_code,
  coalesce(merchant_state, 'UNKNOWN') AS merchant_state, CAST(hour(date_transaction) AS INTEGER) AS hour,
  {_AGE} AS current_age, coalesce(gender, 'UNKNOWN') AS gender"""


@query("labelled_documents", f"""
SELECT id_transaction, {money_sql('cents')} AS amount, code_mcc AS code, is_fraud FROM flat WHERE is_fraud IS NOT NULL""")
def labelled_documents(m: Model):
    rows = tables.labelled_documents(m.docs)
    return rows.select(
        "id_transaction", "amount", "mcc.code", F.when(F.col("fraude.is_fraud"), "Y").otherwise("N").alias("is_fraud")
    )


@query("document_features", f"SELECT {_FEATURES_SQL} FROM flat")
def document_features(m: Model):
    return features.document_features(m.docs, "id_transaction")


@query("legacy_document_features", """
SELECT id_transaction, CAST(cents AS DOUBLE) / 100 AS amount, 'Swipe Transaction' AS use_chip, 0 AS mcc_code,
  'UNKNOWN' AS merchant_state,
  CAST(CASE WHEN id_transaction % 5 = 0 THEN 12 ELSE hour(date_transaction) END AS INTEGER) AS hour,
  CASE WHEN id_client % 3 = 0 THEN 45.0::DOUBLE ELSE CAST(id_client % 90 AS DOUBLE) END AS current_age, 'UNKNOWN' AS gender,
  CASE WHEN id_transaction % 4 = 0 THEN -1 WHEN is_fraud THEN 1 ELSE 0 END AS label
FROM ev""")
def legacy_document_features(m: Model):
    """Documents with the older field names, a text date and gaps."""
    i = F.col("id_transaction")
    docs = m.events.select(
        "id_transaction",
        "amount",
        F.when(i % 5 == 0, "no date").otherwise(F.date_format("date_transaction", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"),
        F.struct(
            F.when(F.col("id_client") % 3 == 0, 0).otherwise(F.col("id_client") % 90).alias("current_age")
        ).alias("client"),
        F.struct(F.lit("").alias("state")).alias("marchand"),
        F.struct(
            (i % 4 != 0).alias("is_labellisee"), F.when(F.col("is_fraud"), "Yes").otherwise("No").alias("is_fraud")
        ).alias("fraude"),
    )
    docs = docs.withColumn("label", F.coalesce(features.document_label(docs), F.lit(-1)))
    return features.document_features(docs, "id_transaction", "label")


@query("training_labels", """
SELECT label, count(*) AS nb FROM (SELECT CASE WHEN is_fraud = 'Y' THEN 1 ELSE 0 END AS label FROM flat
WHERE is_fraud IS NOT NULL) GROUP BY label""")
def training_labels(m: Model):
    return listing.count_by(features.training_rows(m.docs), "label")


@query("request_features", f"""
SELECT id_transaction, {money_sql('cents')} AS amount, coalesce(use_chip, 'Swipe Transaction') AS use_chip,
  coalesce(mcc_code, 0) AS mcc_code, coalesce(merchant_state, 'UNKNOWN') AS merchant_state,
  CAST(coalesce(hour, 12) AS INTEGER) AS hour, CAST(coalesce(current_age, 45) AS DOUBLE) AS current_age,
  coalesce(gender, 'UNKNOWN') AS gender
FROM {_REQUEST_SQL} r""")
def request_features(m: Model):
    return features.request_features(m.requests, "id_transaction")


@query("ordered_features", """
SELECT id_transaction, CAST(cents AS DOUBLE) / 100 AS amount, NULL::VARCHAR AS use_chip, NULL::DOUBLE AS mcc_code,
  NULL::VARCHAR AS merchant_state, NULL::DOUBLE AS hour, NULL::DOUBLE AS current_age, NULL::VARCHAR AS gender
FROM ev""")
def ordered_features(m: Model):
    rows = features.ordered(m.events.select("id_transaction", "amount"), "id_transaction")
    return rows.withColumns({c: F.col(c).cast("double") for c in ("mcc_code", "hour", "current_age")})


def training_table(m: Model):
    """Training rows, stored: they are read several times."""
    return landing.parquet(m, "training", features.training_rows(m.docs))


@query("stratified_split", """
SELECT label, part, CASE part WHEN 'train' THEN n * 4 // 5 ELSE n - n * 4 // 5 END AS nb
FROM (SELECT CASE WHEN is_fraud = 'Y' THEN 1 ELSE 0 END AS label, count(*) AS n FROM flat
      WHERE is_fraud IS NOT NULL GROUP BY 1), (VALUES ('train'), ('test')) p(part)""")
def stratified_split(m: Model):
    train, test = model.split(training_table(m))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return listing.count_by(both, "label", "part")


def trained(m: Model) -> str:
    def write(path: str) -> None:
        fitted, metrics = model.train_and_evaluate(training_table(m))
        model.save(fitted, metrics, path)

    return landing.once(m, "model", write)


@query("model_metrics")
def model_metrics(m: Model):
    row = model.info(m.spark, trained(m)).select(F.from_json(
        "metrics",
        "roc_auc double, pr_auc double, precision_fraud double, recall_fraud double, f1_fraud double, "
        "n_test bigint, n_fraud_test bigint, confusion_matrix map<string,bigint>",
    ).alias("x"))
    return row.select("x.*")


@query("model_info", """SELECT true AS is_loaded, '1.0.0' AS model_version, 'RandomForestClassifier' AS model_type,
'["amount","use_chip","mcc_code","merchant_state","hour","current_age","gender"]' AS feature_columns""")
def model_info(m: Model):
    return model.info(m.spark, trained(m)).drop("metrics")


def _dealt_requests(m: Model):
    """Valid requests over as many tasks as a shuffle of the input starts from: a forest costs a row far more than its
    reading does, and the events are few, large splits."""
    return quality.valid_requests(m.requests).repartition(int(m.spark.conf.get(INITIAL_PARTITIONS)))


@query("scored_requests")
def scored_requests(m: Model):
    """Every valid request with its class, probability and risk level."""
    fitted = model.load(trained(m))
    return model.score(fitted, _dealt_requests(m), "id_transaction").drop("predicted_at", "features_used")


@query("scored_counts", f"SELECT count(*) AS nb FROM {_REQUEST_SQL} r WHERE {_VALID_SQL}")
def scored_counts(m: Model):
    fitted = model.load(trained(m))
    rows = model.score(fitted, _dealt_requests(m), "id_transaction")
    fits = F.col("fraud_probability").between(0, 1) & F.col("risk_level").isin("LOW", "MEDIUM", "HIGH")
    return rows.where(fits).agg(F.count(F.lit(1)).alias("nb"))


@query("batch_prediction")
def batch_prediction(m: Model):
    """Whole document table scored."""
    fitted = model.load(trained(m))
    rows = features.document_features(m.docs, "id_transaction")
    return model.score(fitted, rows, "id_transaction").groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("nb"), F.round(F.avg("fraud_probability"), 6).alias("moyenne")
    )


_DRIFT_BASE = "date_transaction < TIMESTAMP '1998-01-01'"
_EDGE_SQL = {
    name: " ".join(
        f"WHEN {name} >= {low} THEN '{i}'" for i, low in reversed(list(enumerate(edges)))
    )
    for name, edges in drift.EDGES.items()
}


@query("feature_drift", f"""
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi FROM (
  SELECT feature, greatest(coalesce(b, 0) / sum(b) OVER (PARTITION BY feature), 1e-6::DOUBLE) AS p,
         greatest(coalesce(c, 0) / sum(c) OVER (PARTITION BY feature), 1e-6::DOUBLE) AS q
  FROM (SELECT feature, classe, CAST(count(CASE WHEN base THEN 1 END) AS DOUBLE) AS b,
               CAST(count(CASE WHEN NOT base THEN 1 END) AS DOUBLE) AS c
        FROM (SELECT 'amount' AS feature, {_DRIFT_BASE} AS base, CASE {_EDGE_SQL['amount']} ELSE '-1' END AS classe
              FROM (SELECT cents / 100.0 AS amount, date_transaction FROM flat)
              UNION ALL SELECT 'current_age', {_DRIFT_BASE}, CASE {_EDGE_SQL['current_age']} ELSE '-1' END FROM flat
              UNION ALL SELECT 'use_chip', {_DRIFT_BASE}, use_chip FROM flat
              UNION ALL SELECT 'merchant_state', {_DRIFT_BASE}, coalesce(merchant_state, 'UNKNOWN') FROM flat)
        GROUP BY feature, classe)) GROUP BY feature""")
def feature_drift(m: Model):
    rows = landing.parquet(m, "dated_features", features.document_features(m.docs, "date_transaction"))
    cut = moment(datetime(1998, 1, 1))
    return drift.stability_index(
        rows.where(F.col("date_transaction") < cut), rows.where(F.col("date_transaction") >= cut),
        ["amount", "current_age", "use_chip", "merchant_state"],
    )


def _metric_rows(m: Model, results: dict[str, dict]):
    """A handful of results as a frame; they come from jobs over the training table."""
    return m.spark.createDataFrame(
        [(name, json.dumps(r, sort_keys=True)) for name, r in sorted(results.items())], "modele string, mesures string"
    )


@query("model_comparison")
def model_comparison(m: Model):
    return _metric_rows(m, model.compare(training_table(m)))


@query("model_cross_validation")
def model_cross_validation(m: Model):
    found = model.cross_validate(training_table(m), trees=[20, 50], depths=[6, 12], folds=3)
    return _metric_rows(m, {json.dumps({k: r[k] for k in ("maxDepth", "numTrees")}): {"pr_auc": r["pr_auc"]} for r in found})


@query("validation_folds", """
SELECT f.fold, CAST(2 AS BIGINT) AS parts, CAST(sum(n) AS BIGINT) AS nb
FROM (SELECT count(*) AS n FROM label JOIN flat USING (id_transaction)) t, (VALUES (0), (1), (2)) f(fold)
GROUP BY f.fold""")
def validation_folds(m: Model):
    """For each fold the rows inside and outside it: together all rows."""
    rows = training_table(m)
    parts = [
        listing.count_by(rows.select(F.lit(k).alias("fold"), (model.fold_of(3) == k).alias("inside")), "fold", "inside")
        for k in range(3)
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("fold").agg(F.count(F.lit(1)).alias("parts"), F.sum("nb").alias("nb"))


_SCORE_SQL = "CAST(id_transaction % 997 AS DOUBLE)"


@query("metrics_of_scores", f"""
, s AS (SELECT {_SCORE_SQL} AS score, CASE WHEN is_fraud = 'Y' THEN 1 ELSE 0 END AS label FROM label),
c AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM s GROUP BY score),
r AS (SELECT *, sum(p) OVER w - p AS p_above, sum(n) OVER w - n AS n_above, sum(p) OVER w AS p_to, sum(n) OVER w AS n_to,
             (SELECT sum(label) FROM s) AS all_p, (SELECT count(*) - sum(label) FROM s) AS all_n
      FROM c WINDOW w AS (ORDER BY score DESC)),
m AS (SELECT sum(CASE WHEN score >= 900 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN score >= 900 AND label = 0 THEN 1 ELSE 0 END) AS fp,
             sum(label) AS pos, count(*) AS n FROM s)
SELECT (SELECT round(sum(n * (p_above + p / 2.0::DOUBLE)) / any_value(all_p * all_n), 9) FROM r) AS roc_auc,
       round(tp / (tp + fp)::DOUBLE, 9) AS precision_fraud, round(tp / pos::DOUBLE, 9) AS recall_fraud,
       round(2.0::DOUBLE * tp / (tp + fp + pos), 9) AS f1_fraud, n AS n_test, CAST(pos AS BIGINT) AS n_fraud_test,
       CAST(n - pos - fp AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(pos - tp AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp
FROM m""")
def metrics_of_scores(m: Model):
    """The evaluation on a score that follows from the id, so that SQL can tell every figure."""
    score = (F.col("id_transaction") % 997).cast("double")
    rows = m.label_fraude.select(
        F.when(F.col("is_fraud") == "Y", 1).otherwise(0).alias("label"), (score >= 900).cast("double").alias("prediction"), score.alias("rawPrediction")
    )
    x = model.evaluate_scores(rows)
    c = x["confusion_matrix"]
    row = [round(x[k], 9) for k in ("roc_auc", "precision_fraud", "recall_fraud", "f1_fraud")] + [x["n_test"], x["n_fraud_test"], *c.values()]
    return m.spark.createDataFrame(
        [tuple(row)], "roc_auc double, precision_fraud double, recall_fraud double, f1_fraud double, n_test long, n_fraud_test long, tn long, fp long, fn long, tp long"
    )


_GIVEN_SQL = "1 / (1 + exp(-(0.25 * ((id_transaction % 40) - 20))))"


@query("scored_by_given_model", f"""
SELECT id_transaction, {_GIVEN_SQL} > 0.5 AS is_fraud_predicted, round({_GIVEN_SQL}, 4) AS fraud_probability,
       CASE WHEN {_GIVEN_SQL} < 0.3 THEN 'LOW' WHEN {_GIVEN_SQL} < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level
FROM ev""")
def scored_by_given_model(m: Model):
    """Scoring by a logistic model with given weights: amount counts, all else does not."""
    amount = ((F.col("id_transaction") % 40) - 20).cast("double")
    requests = m.requests.withColumn("amount", amount)
    fitted = model.given_logistic(m.spark, {"amount": 0.25}, 0.0)
    return model.score(fitted, requests, "id_transaction").drop("predicted_at", "features_used", "model_version", "model_type")


_GIVEN_BATCH = "1 / (1 + exp(-(0.00002 * amount - 0.5 + 0.01 * current_age)))"


@query("batch_prediction_given_model", f"""
SELECT CASE WHEN p < 0.3 THEN 'LOW' WHEN p < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level, count(*) AS nb, round(avg(round(p, 4)), 6) AS moyenne
FROM (SELECT {_GIVEN_BATCH} AS p FROM (SELECT {_FEATURES_SQL} FROM flat)) GROUP BY 1""")
def batch_prediction_given_model(m: Model):
    """The whole document table scored by a logistic model with given weights."""
    fitted = model.given_logistic(m.spark, {"amount": 0.00002, "current_age": 0.01}, -0.5)
    rows = model.score(fitted, features.document_features(m.docs, "id_transaction"), "id_transaction")
    return rows.groupBy("risk_level").agg(F.count(F.lit(1)).alias("nb"), F.round(F.avg("fraud_probability"), 6).alias("moyenne"))


@query("encoded_features", f"""
, rows_of AS (SELECT {_FEATURES_SQL} FROM flat WHERE is_fraud IS NOT NULL),
u AS (SELECT use_chip, row_number() OVER (ORDER BY use_chip) - 1 AS c FROM (SELECT DISTINCT use_chip FROM rows_of)),
s AS (SELECT merchant_state, row_number() OVER (ORDER BY merchant_state) - 1 AS c FROM (SELECT DISTINCT merchant_state FROM rows_of)),
g AS (SELECT gender, row_number() OVER (ORDER BY gender) - 1 AS c FROM (SELECT DISTINCT gender FROM rows_of)),
n AS (SELECT avg(amount) am, stddev_samp(amount) asd, avg(mcc_code) mm, stddev_samp(mcc_code) msd, avg(current_age) cm, stddev_samp(current_age) csd FROM rows_of)
SELECT id_transaction, round((amount - am) / asd, 6) AS amount, round((mcc_code - mm) / msd, 6) AS mcc_code, round((current_age - cm) / csd, 6) AS current_age,
       CAST(u.c AS DOUBLE) AS use_chip, CAST(s.c AS DOUBLE) AS merchant_state, CAST(g.c AS DOUBLE) AS gender
FROM rows_of JOIN u USING (use_chip) JOIN s USING (merchant_state) JOIN g USING (gender), n""")
def encoded_features(m: Model):
    """Scaled numbers and category codes of the training rows, as the forest gets them."""
    rows = training_table(m)
    out = rows
    for stage in model.encoder(rows):
        out = stage.transform(out)
    v = vector_to_array("features")
    return out.select(
        "id_transaction", *[(F.round(v[i], 6) + 0.0).alias(n) for i, n in ((0, "amount"), (1, "mcc_code"), (3, "current_age"))],
        *[v[4 + i].alias(n) for i, n in enumerate(features.CATEGORICAL)],
    )


_EDGES_SQL = ", ".join(f"quantile_disc(x, {i / 10}) AS e{i}" for i in range(1, 10))
_PLACE_SQL = "CASE " + " ".join(f"WHEN x >= e{i} THEN {i}" for i in range(9, 0, -1)) + " ELSE -1 END"


@query("drift_by_base_edges", f"""
, f AS (SELECT feature, base, x FROM (
  SELECT 'amount' AS feature, {_DRIFT_BASE} AS base, CAST(cents AS DOUBLE) / 100 AS x FROM flat
  UNION ALL SELECT 'current_age', {_DRIFT_BASE}, {_AGE} FROM flat)),
e AS (SELECT feature, {_EDGES_SQL} FROM f WHERE base GROUP BY feature),
c AS (SELECT feature, {_PLACE_SQL} AS classe, CAST(count(CASE WHEN base THEN 1 END) AS DOUBLE) AS b, CAST(count(CASE WHEN NOT base THEN 1 END) AS DOUBLE) AS c
      FROM f JOIN e USING (feature) GROUP BY 1, 2)
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi FROM (
  SELECT feature, greatest(b / sum(b) OVER (PARTITION BY feature), 1e-6::DOUBLE) AS p, greatest(c / sum(c) OVER (PARTITION BY feature), 1e-6::DOUBLE) AS q FROM c) GROUP BY feature""")
def drift_by_base_edges(m: Model):
    """Drift with classes of about equal shares of the base period. The sketch is made fine enough here to be exact, so that SQL can tell the edges."""
    rows = landing.parquet(m, "dated_features", features.document_features(m.docs, "date_transaction"))
    cut = moment(datetime(1998, 1, 1))
    base, names = rows.where(F.col("date_transaction") < cut), ["amount", "current_age"]
    edges = drift.base_edges(base, names, accuracy=100_000_000)
    return drift.stability_index(base, rows.where(F.col("date_transaction") >= cut), names, edges)
