"""Stored datamarts from transactions that carry their label."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom import session
from cardloom.operators import datamarts
from cardloom.plans import marts
from cardloom.suite import landing
from cardloom.suite.base import Model

SMALL = "/root/testdata/sf0.001"


def _own_label(tiny):
    rest = {k: v for k, v in tiny.items() if k != "label_fraude"}
    return {**rest, "transaction": datamarts.labelled(tiny["transaction"], tiny["label_fraude"])}


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_refresh_with_own_label(spark, tiny, tmp_path, rows):
    joined, own = str(tmp_path / "joined"), str(tmp_path / "own")
    marts.refresh_all(tiny, joined)
    marts.refresh_all(_own_label(tiny), own)
    for name in marts.ORDER:
        assert rows(marts.read(spark, own, name)) == rows(marts.read(spark, joined, name)), name


def test_gold_reads_lines_without_numbers(spark, monkeypatch):
    given = []
    monkeypatch.setattr(landing, "_written", {})
    monkeypatch.setattr(marts, "refresh_all", lambda t, path: given.append(t))
    landing.gold(Model(spark, SMALL))
    plan = _plan(marts._labelled(given[0], "id_carte", "amount").groupBy("id_carte").agg(F.count("is_fraud")))
    assert "Window [" not in plan and "Join" not in plan


def test_batches_with_own_label(spark, tiny, tmp_path, rows):
    joined, own = str(tmp_path / "joined"), str(tmp_path / "own")
    for batch, condition in (("1", "id_transaction <= 2"), ("2", "id_transaction > 2")):
        for t, path in ((tiny, joined), (_own_label(tiny), own)):
            marts.apply_batch(spark, {**t, "transaction": t["transaction"].where(condition)}, path, batch)
    for name in ("card", "category"):
        assert rows(marts.read(spark, own, name)) == rows(marts.read(spark, joined, name)), name


def test_a_task_reads_a_bounded_share(spark):
    before = spark.conf.get(session.READ)
    try:
        for asked, kept in (("128m", session.READ_BYTES), ("1m", "1m")):
            spark.conf.set(session.READ, asked)
            session.size_shuffles(spark, SMALL)
            assert spark.conf.get(session.READ) == str(kept)
    finally:
        spark.conf.set(session.READ, before)
