"""Steps whose cost must grow no faster than their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom import session
from cardloom.operators import datamarts
from cardloom.suite.base import Model

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def m(spark):
    return Model(spark, SMALL)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _same(a, b) -> bool:
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_partitions_follow_the_input(spark):
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.size_shuffles(spark, SMALL) == asked
    assert session.size_shuffles(spark, "/root/testdata/sf0.1") > asked
    assert int(spark.conf.get(session.INITIAL_PARTITIONS)) > asked
    if before is None:
        spark.conf.unset(session.INITIAL_PARTITIONS)
    else:
        spark.conf.set(session.INITIAL_PARTITIONS, before)


def test_partitions_are_merged_up_to_a_bound(spark):
    before = spark.conf.get(session.ADVISORY)
    try:
        for asked, kept in (("64m", session.MERGED_BYTES), ("8m", "8m")):
            spark.conf.set(session.ADVISORY, asked)
            session.size_shuffles(spark, SMALL)
            assert spark.conf.get(session.ADVISORY) == str(kept)
    finally:
        spark.conf.set(session.ADVISORY, before)


def test_labels_without_a_join(m):
    assert _same(m.labelled_transaction, datamarts.labelled(m.transaction, m.label_fraude))
    assert _plan(m.flat).count("Window [") == 1
    # what does not use the id is not numbered
    assert "Window [" not in _plan(m.docs.groupBy("mcc.code").agg(F.count("fraude.is_fraud")))


def test_errors_without_a_join(m):
    assert _same(m.transaction_with_errors, m.transaction.join(m.error_texts, "id_transaction"))
    assert _plan(m.transaction_with_errors).count("Window [") == 1
