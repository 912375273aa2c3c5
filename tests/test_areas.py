"""Both areas of a set of scores by one sorting of them."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cardloom.learning import model


def test_areas_of_one_count(spark):
    """Those of the evaluator, ties of scores among them; the sorted counts are not left stored."""
    h = F.pmod(F.xxhash64("id"), F.lit(400))
    rows = spark.range(0, 3000, 1, 3).select((h + F.pmod("id", F.lit(500)) > 500).cast("int").alias("label"), (h / 400).alias("rawPrediction"))
    names = ["areaUnderROC", "areaUnderPR"]
    wanted = [BinaryClassificationEvaluator(labelCol="label", metricName=n, numBins=0).evaluate(rows) for n in names]
    stored = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert model.areas(rows, *names) == pytest.approx(wanted, abs=1e-12)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == stored
