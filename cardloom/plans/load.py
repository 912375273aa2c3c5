"""Batch load of the raw files into the model tables, step by step."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import derive
from cardloom.session import path_exists
from cardloom.sources import raw, tables


@dataclass(frozen=True)
class Load:
    """Where the raw files are, where the tables go, how they are written.

    ``situation_date`` defaults to the load day; ``key`` is the base64 AES key,
    without which the secret columns are refused.
    """

    spark: SparkSession
    source: str
    target: str
    key: str
    situation_date: Column | None = None

    def path(self, table: str) -> str:
        return f"{self.target}/{table}"

    def _raw_transactions(self, columns: list[str] | None = None) -> DataFrame:
        return raw.transactions(self.spark, f"{self.source}/transactions_data.csv", columns)

    def _empty(self, table: str) -> str:
        """Path of a table without rows: a second load would repeat every key."""
        path = self.path(table)
        if path_exists(self.spark, path) and not self.spark.read.parquet(path).isEmpty():
            raise ValueError(f"{path} has rows already")
        return path

    def _write(self, df: DataFrame, table: str) -> None:
        path = self._empty(table)
        stamped = tables.typed(df.withColumn("date_creation", F.current_timestamp()), table)
        tables.append(stamped, path)

    def mcc(self) -> None:
        tables.append(
            tables.typed(raw.mcc_codes(self.spark, f"{self.source}/mcc_codes.json"), "mcc"), self._empty("mcc")
        )

    def clients(self) -> None:
        self._write(raw.clean_users(raw.users(self.spark, f"{self.source}/users_data.csv"), self.key), "client")

    def cards(self) -> None:
        self._write(raw.clean_cards(raw.cards(self.spark, f"{self.source}/cards_data.csv"), self.key), "carte")

    def marchands(self) -> None:
        columns = ["id", "merchant_id", "mcc", "merchant_city", "merchant_state", "zip"]
        self._write(derive.merchants(raw.merchant_fields(self._raw_transactions(columns))), "marchand")

    def transactions(self) -> None:
        rows = raw.clean_transactions(self._raw_transactions(), self.situation_date)
        stamped = tables.typed(rows.withColumn("date_creation", F.current_timestamp()), "transaction")
        tables.write_monthly(stamped, self._empty("transaction"))

    def labels(self) -> None:
        self._write(raw.fraud_labels(self.spark, f"{self.source}/train_fraud_labels.json"), "label_fraude")

    def errors(self) -> None:
        rows = raw.error_fields(self._raw_transactions(["id", "errors"]))
        self._write(derive.error_rows(rows), "erreur_transaction")


# Parents are loaded before their children.
STEPS = ("mcc", "clients", "cards", "marchands", "transactions", "labels", "errors")


def run(load: Load, steps: Iterable[str] = STEPS) -> None:
    """Runs the steps in load order. Each is one job whose output appears as a whole or not at all."""
    wanted = set(steps)
    unknown = wanted - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}")
    for step in STEPS:
        if step in wanted:
            job: Callable[[], None] = getattr(load, step)
            job()
