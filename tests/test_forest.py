"""The forest by counts: against splits worked out row by row, and alike however the work is dealt."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cardloom.learning import forest, model

FEATURES = 7


@pytest.fixture(scope="module")
def ready(spark):
    """Two features with few values, one value of them a single row's; the label leans on the first and the third."""
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).cast("double") for i in range(FEATURES)]
    x = [h[0], F.floor(h[1] / 300).cast("double"), h[2], F.when(F.col("id") == 7, 5.0).otherwise(0.0), h[4], h[5], h[6]]
    rows = spark.range(0, 4000, 1, 4).select(array_to_vector(F.array(*x)).alias("features"), ((h[0] > 700) & (h[2] > 300)).cast("int").alias("label"))
    return model.balanced(rows, model.class_counts(rows))


@pytest.fixture(scope="module")
def fitted(ready):
    return model.forest(trees=3, depth=5).fit(ready)


def _form(fitted) -> list[str]:
    return [t.toDebugString.split("\n", 1)[1] for t in fitted.trees]


def test_same_forest_however_dealt(ready, fitted, monkeypatch):
    monkeypatch.setattr(forest, "TASKS_PER_CORE", 0.1)
    monkeypatch.setattr(forest, "NODES_AT_ONCE", 3)
    monkeypatch.setattr(forest, "ROWS_AT_ONCE", 77)
    assert _form(model.forest(trees=3, depth=5).fit(ready)) == _form(fitted)


def test_fewer_trees_are_a_part(ready, fitted):
    assert _form(model.forest(trees=1, depth=5).fit(ready)) == _form(fitted)[:1]


def test_borders_come_from_all_rows(ready):
    edges = forest._edges(ready.select(vector_to_array("features").alias("x")), 64)
    assert edges[1].tolist() == [0.5, 1.5, 2.5] and edges[3].tolist() == [2.5]
    assert len(edges[0]) == 63 and (np.diff(edges[0]) > 0).all()


def test_root_split_by_hand(ready, fitted):
    """The first split of every tree, worked out from its draws row by row over all borders of its three features."""
    edges = forest._edges(ready.select(vector_to_array("features").alias("x")), 64)
    parts = ready.select(F.spark_partition_id().alias("p"), vector_to_array("features").alias("x"), "label", "weight").toPandas()
    for t, tree in enumerate(fitted.trees):
        times = np.concatenate([forest.drawn(model.SEED, t, p, len(g)) for p, g in parts.groupby("p")])
        x, label, w = np.stack(parts["x"]), parts["label"].to_numpy(), times * parts["weight"].to_numpy()

        def gini(mask):
            share = w[mask & (label == 1)].sum() / w[mask].sum()
            return 2 * share * (1 - share)

        def gain(f, e):
            low = x[:, f] <= e
            if min(times[low].sum(), times[~low].sum()) < 5:
                return -1.0
            return gini(w >= 0) - (w[low].sum() * gini(low) + w[~low].sum() * gini(~low)) / w.sum()

        best = max(gain(f, e) for f in forest.features_of(model.SEED, t, 0, FEATURES)[0] for e in edges[f])
        root = tree._java_obj.rootNode()
        assert root.impurityStats().rawCount() == times.sum()
        assert root.gain() == pytest.approx(best, abs=1e-9)
        assert gain(root.split().featureIndex(), root.split().threshold()) == pytest.approx(best, abs=1e-9)


def test_rows_end_in_the_counted_leaves(ready, fitted):
    """Every draw is counted in one leaf: the leaves' counts are those of the rows that the stored model sends there."""
    for t, tree in enumerate(fitted.trees):
        tree.setLeafCol("leaf")
        scored = tree.transform(ready).select(F.spark_partition_id().alias("p"), "leaf").toPandas()
        scored["times"] = np.concatenate([forest.drawn(model.SEED, t, p, len(g)) for p, g in scored.groupby("p")])
        leaves = []

        def walk(node):
            if node.subtreeDepth() == 0:
                leaves.append(node.impurityStats().rawCount())
            else:
                walk(node.leftChild())
                walk(node.rightChild())

        walk(tree._java_obj.rootNode())
        assert scored.groupby("leaf")["times"].sum().reindex(range(len(leaves)), fill_value=0).tolist() == leaves


def test_draws_are_poisson():
    times = forest.drawn(1, 2, 3, 200_000)
    share = np.bincount(times, minlength=4)[:4] / len(times)
    assert share == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.005)


def test_weights_must_follow_the_label(ready):
    with pytest.raises(ValueError):
        model.forest(trees=1, depth=1).fit(ready.withColumn("weight", F.rand(1)))
