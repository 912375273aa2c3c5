"""Stored datamarts: full refresh and incremental refresh."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import datamarts as d
from cardloom.operators.skew import fits_broadcast
from cardloom.session import path_exists
from cardloom.sources import tables
from cardloom.sources.versions import Versions

# Refresh order.
ORDER = ("card", "daily", "category")


def _labelled(t: dict[str, DataFrame], *columns: str) -> DataFrame:
    """Columns of the transactions with their label: their own ``is_fraud``, else that of the label table."""
    tx = t["transaction"]
    if "is_fraud" in tx.columns:
        return tx.select(*columns, "is_fraud")
    return d.labelled(tx.select("id_transaction", *columns), t["label_fraude"])


def build(name: str, t: dict[str, DataFrame]) -> DataFrame:
    if name == "card":
        return d.card_datamart(t["transaction"], t["label_fraude"])
    if name == "daily":
        return d.daily_datamart(t["transaction"], t["label_fraude"])
    if name == "category":
        return d.category_datamart(t["transaction"], t["marchand"], t["mcc"])
    raise ValueError(f"datamart must be one of {ORDER}")


def publish(df: DataFrame, path: str, version: str | None = None) -> None:
    """Writes a datamart beside the one that is served and switches whole: readers meet the former or the new one."""
    Versions(df.sparkSession, path).write(df, version or f"{time.time_ns():020d}")


def refresh(name: str, t: dict[str, DataFrame], gold: str) -> None:
    publish(build(name, t), f"{gold}/{name}")


def refresh_all(t: dict[str, DataFrame], gold: str) -> None:
    """The three datamarts from one read of the fact and at most one label join.

    What they share is stored first: volumes per (card, day, category), a row or
    less per transaction. A merchant table above the broadcast threshold meets rows
    reduced to (card, day, merchant).
    """
    version = f"{time.time_ns():020d}"
    shared = f"{gold}/shared/{version}"
    spark = t["transaction"].sparkSession
    rows = _labelled(t, "id_carte", "situation_date", "id_marchand", "amount")
    codes = t["marchand"].select("id_marchand", "code_mcc")
    keys = ["id_carte", "situation_date"]
    if fits_broadcast(t["marchand"]):
        groups = d._volume(rows.join(F.broadcast(codes), "id_marchand", "left"), [*keys, "code_mcc"], "n")
    else:
        groups = d._volume(rows, [*keys, "id_marchand"], "n").join(codes, "id_marchand", "left").drop("id_marchand")
    groups.write.mode("overwrite").parquet(shared)
    groups = spark.read.parquet(shared)

    def sums(df: DataFrame, by: list[str], count_name: str) -> DataFrame:
        return df.groupBy(*by).agg(
            F.sum("n").alias(count_name), F.sum("total_amount").cast("decimal(22,2)").alias("total_amount"),
            F.sum("_nb_amounts").alias("_nb_amounts"), F.sum("nb_fraudes").alias("nb_fraudes"),
        )

    publish(d._finished(sums(groups, ["id_carte"], "nb_transactions"), ["id_carte"], "nb_transactions"), f"{gold}/card", version)
    publish(d._finished(sums(groups, ["situation_date"], "nb_tx"), ["situation_date"], "nb_tx"), f"{gold}/daily", version)
    pairs = groups.where("code_mcc is not null").groupBy("code_mcc", "id_carte").agg(
        F.sum("n").alias("n"), F.sum("total_amount").alias("s"), F.sum("_nb_amounts").alias("na")
    )
    publish(d.category_totals(pairs, t["mcc"]), f"{gold}/category", version)


def refresh_days(t: dict[str, DataFrame], gold: str, first: date, last: date) -> None:
    """Daily datamart of a date range: only its days are read and replaced.

    The stored table is partitioned by day; other partitions stay as they are.
    """
    tx = t["transaction"]
    if tables.MONTH in tx.columns:
        tx = tables.in_months(tx, first, last)
    else:
        tx = tx.where(F.col("situation_date").between(F.lit(first), F.lit(last)))
    (
        d.daily_datamart(tx, t["label_fraude"])
        .repartition("situation_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("situation_date")
        .parquet(f"{gold}/daily_by_day")
    )


# Mergeable state of the card and category datamarts. A batch is reduced to the
# state's key, added to the old state, and the datamart is read off the sum;
# distinct cards need the (category, card) pairs themselves.


def card_state(t: dict[str, DataFrame]) -> DataFrame:
    return d._volume(_labelled(t, "id_carte", "amount"), ["id_carte"], "nb_transactions")


def pair_state(tx: DataFrame, merchant: DataFrame) -> DataFrame:
    return d.category_cards(tx, merchant)


def _summed(df: DataFrame, keys: list[str]) -> DataFrame:
    figures = [c for c in df.columns if c not in keys]
    kinds = dict(df.dtypes)
    return df.groupBy(*keys).agg(
        *[
            (F.sum(c).cast("decimal(38,2)") if kinds[c].startswith("decimal") else F.sum(c)).alias(c)
            for c in figures
        ]
    )


def added(old: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    return _summed(batch if old is None else old.unionByName(batch), keys)


def card_from_state(state: DataFrame) -> DataFrame:
    return d._finished(state, ["id_carte"], "nb_transactions")


def category_from_state(state: DataFrame, mcc: DataFrame) -> DataFrame:
    return d.category_totals(state, mcc)


def apply_batch(spark: SparkSession, t: dict[str, DataFrame], gold: str, batch_id: str) -> None:
    """Folds a batch of new transactions into the stored state and rewrites the two datamarts.

    ``t`` holds the new transactions with their labels, in a table or in ``is_fraud`` of their own. Each state version is a
    folder of its own, named by the batch, so a job that dies half-way leaves
    the former version whole and a repeated batch rewrites its own folder.
    """
    card = added(_state(spark, gold, "card", batch_id), card_state(t), ["id_carte"])
    tables.overwrite(card, f"{gold}/state/card/{batch_id}")
    pair = added(
        _state(spark, gold, "pair", batch_id),
        pair_state(t["transaction"], t["marchand"]),
        ["code_mcc", "id_carte"],
    )
    tables.overwrite(pair, f"{gold}/state/pair/{batch_id}")
    tables.overwrite(card_from_state(spark.read.parquet(f"{gold}/state/card/{batch_id}")), f"{gold}/card")
    pairs = spark.read.parquet(f"{gold}/state/pair/{batch_id}")
    tables.overwrite(category_from_state(pairs, t["mcc"]), f"{gold}/category")


def _state(spark: SparkSession, gold: str, kind: str, batch_id: str) -> DataFrame | None:
    """Newest complete state before this batch (batch ids sort by time)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{gold}/state/{kind}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(root))
    done = [n for n in names if n < batch_id and path_exists(spark, f"{gold}/state/{kind}/{n}/_SUCCESS")]
    return spark.read.parquet(f"{gold}/state/{kind}/{done[-1]}") if done else None


def read(spark: SparkSession, gold: str, name: str) -> DataFrame:
    stored = Versions(spark, f"{gold}/{name}")
    return stored.read() if stored.versions() else spark.read.parquet(f"{gold}/{name}")
