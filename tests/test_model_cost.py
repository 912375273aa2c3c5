"""What the model jobs share, and that sharing does not change the result."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cardloom.learning import forest, model


@pytest.fixture(scope="module")
def training(spark):
    h = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    return spark.range(0, 900, 1, 2).select(
        F.col("id").alias("id_transaction"), (h(1, 1000) / 7).alias("amount"), F.concat(F.lit("c"), h(2, 3)).alias("use_chip"),
        h(3, 20).cast("int").alias("mcc_code"), F.concat(F.lit("S"), h(4, 30)).alias("merchant_state"), h(5, 24).cast("int").alias("hour"),
        h(6, 70).cast("double").alias("current_age"), F.concat(F.lit("g"), h(7, 2)).alias("gender"), (h(1, 1000) > 800).cast("int").alias("label"),
    )


@pytest.fixture
def calls(monkeypatch):
    found = []
    before = model.encoded
    monkeypatch.setattr(model, "encoded", lambda *a: found.append(1) or before(*a))
    return found


def test_comparison_encodes_once(training, calls):
    assert len(model.compare(training, trees=2)) == 3 and len(calls) == 1


def test_counts_by_hand():
    """Counts of a level against a walk row by row, with leaves above it and rows that no tree takes."""
    rng = np.random.default_rng(5)
    n, features, bins, level = 500, 7, 8, 3
    x = np.zeros((n, 8), np.uint8)
    x[:, :features], x[:, features] = rng.integers(0, bins, (n, features)), rng.integers(0, 2, n)
    feature, edge = rng.integers(0, features, 7).astype(np.int8), rng.integers(1, 6, 7).astype(np.uint8)
    feature[4] = -1
    opened, times = np.array([0, 1, 5, 6]), rng.integers(0, 3, n).astype(np.uint8)
    chosen = np.array([[0, 2, 5], [1, 2, 3], [4, 5, 6], [0, 1, 6]])
    wanted = np.zeros((4, 3, bins, 2), int)
    for row, k in zip(x, times):
        node = 0
        while node < 7 and feature[node] >= 0:
            node = 2 * node + 1 + (row[feature[node]] > edge[node])
        if node - 7 in opened.tolist():
            i = opened.tolist().index(node - 7)
            for j in range(3):
                wanted[i, j, row[chosen[i, j]], row[features]] += k
    got = forest._counts(x, features, times, feature, edge, opened, chosen, level, bins)
    assert (got.reshape(wanted.shape) == wanted).all()


def test_a_fold_grows_one_forest(training, calls, monkeypatch):
    grown = []
    before = forest.Forest.grown
    monkeypatch.setattr(forest.Forest, "grown", lambda self, rows: grown.append(1) or before(self, rows))
    assert len(model.cross_validate(training, trees=[1, 3], depths=[2, 4], folds=2)) == 4
    assert len(grown) == len(calls) == 2


def test_scores_of_cuts_are_those_of_models(spark):
    """Votes of a forest, and of its cuts, are the ``rawPrediction`` of models fitted apart, to the last bit."""
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).cast("double") for i in range(7)]
    rows = spark.range(0, 3000, 1, 3).select(array_to_vector(F.array(*h)).alias("features"), ((h[0] > 700) & (h[2] > 300)).cast("int").alias("label"))
    ready = model.balanced(rows, model.class_counts(rows))
    cuts = [(2, 3), (4, 3), (4, 6)]
    got = model.forest(4, 6).grown(ready).scores(ready, cuts).collect()
    for i, cut in enumerate(cuts):
        wanted = model.forest(*cut).fit(ready).transform(ready).select("label", "rawPrediction").collect()
        assert [(r.label, r.votes[i]) for r in got] == [(r.label, r.rawPrediction.toArray().tolist()) for r in wanted]
