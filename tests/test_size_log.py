"""The log of changes under ids far apart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cardloom.operators import datamarts
from cardloom.plans.deltas import LOG_PARTS, Deltas


def _same(a, b) -> bool:
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_log_of_sparse_ids_has_few_parts(spark, tiny, tmp_path):
    """Ids far apart: few folders, and the rows before a batch are still found in ranges of either width."""
    rows = [(i * 10**10, i % 7, 100, date(2024, 1, 1 + i % 5), None) for i in range(-3, 300)]
    tx = spark.createDataFrame(rows, "id_transaction bigint, id_carte bigint, id_marchand bigint, situation_date date, amount string")
    tx = tx.withColumn("amount", F.lit("1.00").cast("decimal(12,2)"))
    none, ids = tiny["label_fraude"].limit(0), tx.select("id_transaction")
    state = Deltas(spark, str(tmp_path / "gold"), parts=2)
    state.apply("0001", tx, none, ids.limit(0), tiny["marchand"])
    assert len(state._log_parts("0002")) <= LOG_PARTS + 1
    few = tx.where("id_transaction in (0, 10000000000)").withColumn("amount", F.lit("3.00").cast("decimal(12,2)"))
    state.apply("0002", few, none, ids.limit(0), tiny["marchand"])
    state.apply("0003", tx.limit(0), spark.createDataFrame([(0, "Y"), (5, "Y")], "id_transaction bigint, is_fraud string"), ids.where(F.col("id_transaction") == 10**10), tiny["marchand"])
    assert len({w for _, w, _ in state._log_parts("0004")}) > 1
    kept = tx.where(F.col("id_transaction") != 10**10).withColumn("amount", F.when(F.col("id_transaction") == 0, 3).otherwise(1).cast("decimal(12,2)"))
    label = spark.createDataFrame([(0, "Y")], "id_transaction bigint, is_fraud string")
    assert _same(state.card_datamart(), datamarts.card_datamart(kept, label))
    assert _same(state.daily_datamart(), datamarts.daily_datamart(kept, label))
