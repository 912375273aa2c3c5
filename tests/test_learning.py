from __future__ import annotations

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardloom.learning import drift, features, model
from cardloom.operators.quality import valid_requests

DOC = (
    "amount double, use_chip string, date string, client struct<current_age: int, gender: string>, "
    "marchand struct<etat: string, state: string>, mcc struct<code: int>, "
    "fraude struct<labelled: boolean, is_labellisee: boolean, is_fraud: string>"
)


def one(df):
    return df.first().asDict()


def test_full_document(spark):
    df = spark.createDataFrame(
        [(42.5, "Chip Transaction", "2024-01-15T14:30:00", (35, "Female"), ("CA", None), (5411,), (True, None, "Yes"))], DOC
    )
    assert one(features.document_features(df)) == {
        "amount": 42.5, "use_chip": "Chip Transaction", "mcc_code": 5411, "merchant_state": "CA",
        "hour": 14, "current_age": 35.0, "gender": "Female",
    }


def test_only_amount(spark):
    df = spark.createDataFrame([(100.0,)], "amount double")
    assert one(features.document_features(df)) == {**features.DEFAULTS, "amount": 100.0}


def test_gaps_and_older_names(spark):
    df = spark.createDataFrame(
        [
            (None, "", "not a date", (0, ""), ("", "NY"), (0,), (None, True, "No")),
            (1.0, None, "2024-01-15", (None, None), None, None, None),
            (1.0, None, "2024-01-15T23:30:00+02:00", (None, None), None, None, (False, True, "Yes")),
        ],
        DOC,
    )
    got = [r.asDict() for r in features.document_features(df).collect()]
    assert got[0] == {**features.DEFAULTS, "merchant_state": "NY"}
    assert [g["hour"] for g in got] == [12, 0, 23]
    assert [r[0] for r in df.select(features.document_label(df)).collect()] == [0, None, None]


def test_labels(spark):
    for kind, values in (("string", ("Yes", "No", "?")), ("boolean", (True, False, None))):
        df = spark.createDataFrame(
            [((True, v),) for v in values] + [((False, values[0]),), (None,)],
            f"fraude struct<labelled: boolean, is_fraud: {kind}>",
        )
        assert [r[0] for r in df.select(features.document_label(df)).collect()] == [1, 0, None, None, None]


def test_timestamp_documents(spark):
    df = spark.sql("SELECT timestamp '2024-01-15 07:00:00' AS date_transaction, 5 AS amount")
    assert one(features.document_features(df))["hour"] == 7


def test_request_defaults_keep_zero(spark):
    df = spark.createDataFrame([(50.0, 0, 0.0, "")], "amount double, hour int, current_age double, gender string")
    assert one(features.request_features(df)) == {**features.DEFAULTS, "amount": 50.0, "hour": 0, "current_age": 0.0}
    assert features.ordered(df).columns == list(features.FEATURES)
    assert one(features.ordered(df))["use_chip"] is None


@pytest.fixture(scope="module")
def training(spark):
    """Fraud is likelier for large online amounts."""
    i = F.col("id")
    amount = (F.pmod(F.xxhash64("id"), F.lit(10000)) / 10).cast("double")
    chip = F.element_at(F.array(*[F.lit(x) for x in ("Swipe Transaction", "Chip Transaction", "Online Transaction")]), (i % 3 + 1).cast("int"))
    return spark.range(3000).select(
        i.alias("id_transaction"),
        amount.alias("amount"),
        chip.alias("use_chip"),
        (5000 + i % 20).cast("int").alias("mcc_code"),
        F.concat(F.lit("S"), (i % 40).cast("string")).alias("merchant_state"),
        (i % 24).cast("int").alias("hour"),
        (18 + i % 60).cast("double").alias("current_age"),
        F.when(i % 2 == 0, "Male").otherwise("Female").alias("gender"),
        ((amount > 850) & (i % 3 == 2)).cast("int").alias("label"),
    )


@pytest.fixture(scope="module")
def fitted(training):
    return model.train_and_evaluate(training, model.forest(trees=10, depth=6))


def test_split_is_exact_disjoint_and_repeatable(training, rows):
    train, test = model.split(training)
    n = model.class_counts(training)
    assert model.class_counts(train) == {k: v * 4 // 5 for k, v in n.items()}
    assert model.class_counts(test) == {k: v - v * 4 // 5 for k, v in n.items()}
    assert train.join(test, "id_transaction").count() == 0
    assert rows(model.split(training)[1], "id_transaction") == rows(test, "id_transaction")
    assert rows(model.split(training, seed=1)[1], "id_transaction") != rows(test, "id_transaction")


def test_split_of_few_rows(training):
    few = training.where("id_transaction < 40")
    n = model.class_counts(few)
    train, test = model.split(few)
    assert model.class_counts(train) == {k: v * 4 // 5 for k, v in n.items() if v * 4 // 5}
    assert train.count() + test.count() == 40


def test_metrics(fitted):
    _, m = fitted
    c = m["confusion_matrix"]
    assert sum(c.values()) == m["n_test"] and c["true_positive"] + c["false_negative"] == m["n_fraud_test"]
    assert m["roc_auc"] > 0.95 and m["recall_fraud"] > 0.8


def test_too_few_rows(training):
    with pytest.raises(ValueError):
        model.train_and_evaluate(training.where("id_transaction < 99"))


def test_unseen_category_gets_minus_one(fitted, training):
    odd = training.limit(1).withColumn("merchant_state", F.lit("never seen"))
    vector = fitted[0].transform(odd).select("features").first()[0]
    assert vector[5] == -1.0


def test_save_load_score(spark, fitted, training, tmp_path):
    folder = str(tmp_path)
    model.save(*fitted, folder)
    back = model.load(folder)
    full = spark.createDataFrame(
        [
            (1, 900.0, "Online Transaction", 5002, "S2", 0, 30.0, "Male"),
            (2, 10.0, None, None, None, None, None, None),
            (3, -5.0, None, None, None, None, None, None),
        ],
        "id int, amount double, use_chip string, mcc_code int, merchant_state string, hour int, current_age double, gender string",
    )
    got = {r.id: r for r in model.score(back, valid_requests(full), "id").collect()}
    assert set(got) == {1, 2}
    assert all(0 <= r.fraud_probability <= 1 for r in got.values())
    assert got[1].features_used.hour == 0 and got[2].features_used.hour == 12
    assert got[1].model_version == "1.0.0" and got[2].risk_level == "LOW"
    # scores of the training rows are those of the model before it was stored
    scored = {r.id_transaction: r.is_fraud_predicted for r in model.score(back, training, "id_transaction").collect()}
    direct = {r.id_transaction: r.prediction == 1.0 for r in fitted[0].transform(training).collect()}
    assert scored == direct and 0 < sum(scored.values()) < 3000
    info = model.info(spark, folder).first()
    assert info.model_type == "RandomForestClassifier" and '"roc_auc"' in info.metrics


def test_four_rows_train(spark, training):
    some = training.where("label = 1").limit(2).unionByName(training.where("label = 0").limit(2))
    m = model.fit(some, model.forest(trees=5, depth=3))
    p = [r.fraud_probability for r in model.score(m, some).collect()]
    assert all(0 <= x <= 1 for x in p)


def test_comparison_and_grid(training):
    found = model.compare(training, trees=5)
    assert set(found) == {"LogisticRegression", "RandomForestClassifier", "GBTClassifier"}
    assert all(0 <= m["pr_auc"] <= 1 for m in found.values())
    grid = model.cross_validate(training, trees=[3], depths=[2, 4], folds=2)
    assert [(r["numTrees"], r["maxDepth"]) for r in grid] == [(3, 2), (3, 4)] and all(0 <= r["pr_auc"] <= 1 for r in grid)


def test_grid_equals_single_fits(training):
    """Settings that share the encoded rows of a fold get the areas of fits of their own."""
    grid = model.cross_validate(training, trees=[2, 3], depths=[3], folds=2)
    for found in grid:
        areas = []
        for k in range(2):
            inside = model.fold_of(2) == k
            areas.append(model.evaluate(model.fit(training.where(~inside), model.forest(found["numTrees"], 3)), training.where(inside))["pr_auc"])
        assert found["pr_auc"] == pytest.approx(sum(areas) / 2, abs=1e-12)


def test_areas_by_sql(fitted, training):
    """Both areas of a fitted forest, worked out anew from its scores: step by step over the distinct scores."""
    _, test = model.split(training)
    got = model.evaluate(fitted[0], test)
    scores = fitted[0].transform(test).select("label", vector_to_array("rawPrediction")[1].alias("score")).toPandas()
    area, roc = duckdb.sql("""
        WITH c AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM scores GROUP BY score),
        r AS (SELECT score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS ap, sum(n) OVER () AS an FROM c WINDOW w AS (ORDER BY score DESC)),
        s AS (SELECT *, tp / ap AS recall, tp / (tp + fp) AS precision, lag(tp / ap, 1, 0) OVER w AS recall0,
                     coalesce(lag(tp / (tp + fp)) OVER w, tp / (tp + fp)) AS precision0 FROM r WINDOW w AS (ORDER BY score DESC))
        SELECT sum((recall - recall0) * (precision + precision0) / 2), sum(n * (tp - p / 2)) / any_value(ap * an) FROM s""").fetchall()[0]
    assert got["pr_auc"] == pytest.approx(area, abs=1e-9) and got["roc_auc"] == pytest.approx(roc, abs=1e-9)


def test_trees_keep_the_bounds(training):
    """Every tree: at most 12 levels, at least five rows in a leaf and ten in a split node; counts add up; splits gain purity."""
    ready = model.encoded(training)[1]
    forest = model.forest(trees=6).fit(ready)
    assert forest.getNumTrees == 6
    for tree in forest.trees:
        seen = []

        def walk(node, depth):
            seen.append(depth)
            stats = list(node.impurityStats().stats())
            whole = sum(stats)
            gini = 1 - sum((x / whole) ** 2 for x in stats)
            # -1 marks a leaf for which no valid split was found
            assert node.impurity() == pytest.approx(gini, abs=1e-9) or (node.subtreeDepth() == 0 and node.impurity() == -1.0)
            assert node.prediction() == max(range(len(stats)), key=lambda c: stats[c])
            rows = node.impurityStats().rawCount()
            if node.subtreeDepth() == 0:
                assert rows >= 5 or depth == 0
                return rows
            assert rows >= 10 and node.gain() > 0
            assert walk(node.leftChild(), depth + 1) + walk(node.rightChild(), depth + 1) == rows
            return rows

        walk(tree._java_obj.rootNode(), 0)
        assert max(seen) == tree.depth <= 12 and len(seen) == tree.numNodes


def test_drift(training):
    same = {r.feature: r.psi for r in drift.stability_index(training, training, ["amount", "gender"]).collect()}
    assert same == {"amount": 0.0, "gender": 0.0}
    moved = training.withColumn("amount", F.col("amount") * 50)
    assert drift.stability_index(training, moved, ["amount"]).first().psi > 1
