"""Bronze, silver and gold layers; erasure and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions.crypto import pseudonym
from cardloom.operators import derive, quality
from cardloom.sources import raw


def to_bronze(spark: SparkSession, csv_path: str, bronze: str, situation_date: Column) -> None:
    """Raw transaction rows as read, malformed ones included, by situation date."""
    rows = raw.read_csv(spark, csv_path, raw.RAW_COLUMNS["transactions"], keep_corrupt=True)
    dated = rows.withColumn("situation_date", situation_date).hint("rebalance", "situation_date")
    dated.write.mode("append").partitionBy("situation_date").parquet(bronze)


def bronze_report(bronze: DataFrame) -> DataFrame:
    """Rejected rows and their share."""
    return raw.reject_rate(bronze)


def silver_transactions(bronze: DataFrame, card: DataFrame, merchant: DataFrame, limit: float | None = None) -> DataFrame:
    """Typed, unique transactions that keep the table rules and whose card and merchant exist.

    ``limit`` sets rows aside whose absolute amount is above it.
    """
    typed = raw.clean_transactions(bronze.where(F.col(raw.CORRUPT).isNull()), F.col("situation_date"))
    for rule in quality.rules_for("transaction").values():
        typed = typed.where(rule)
    if limit is not None:
        typed = typed.where(F.abs("amount") <= limit)
    rows = derive.unique_rows(typed, "id_transaction")
    return known_parents(rows, card, merchant)


def known_parents(tx: DataFrame, card: DataFrame, merchant: DataFrame) -> DataFrame:
    """Transactions with an existing card and merchant, by one semi join per parent."""
    for key, parent in (("id_carte", card), ("id_marchand", merchant)):
        tx = tx.join(parent.select(key), key, "left_semi")
    return tx


def erased(t: dict[str, DataFrame], clients: DataFrame) -> dict[str, DataFrame]:
    """Tables without the given clients (column id_client) and all that hangs on them.

    Children are keyed by card and transaction, so the lost keys are derived
    first and each table loses them by anti join. Of the journal go the rows about
    the clients and about their cards.
    """
    ids = clients.select("id_client").distinct()
    cards = t["carte"].join(ids, "id_client", "left_semi").select("id_carte")
    lost = t["transaction"].join(cards, "id_carte", "left_semi").select("id_transaction")
    out = dict(t)
    for child in ("label_fraude", "erreur_transaction"):
        if child in t:
            out[child] = t[child].join(lost, "id_transaction", "left_anti")
    if "journal_audit" in t:
        gone = ids.select(F.lit("client").alias("table_concernee"), F.col("id_client").alias("id_ligne_concernee")).unionByName(
            cards.select(F.lit("carte").alias("table_concernee"), F.col("id_carte").alias("id_ligne_concernee"))
        )
        out["journal_audit"] = t["journal_audit"].join(gone, ["table_concernee", "id_ligne_concernee"], "left_anti")
    out["transaction"] = t["transaction"].join(cards, "id_carte", "left_anti")
    out["carte"] = t["carte"].join(ids, "id_client", "left_anti")
    out["client"] = t["client"].join(ids, "id_client", "left_anti")
    return out


def pseudonymised(df: DataFrame, salt: Column, column: str = "id_client") -> DataFrame:
    """The id replaced by a keyed hash; equal ids stay joinable."""
    return df.withColumn(column, pseudonym(F.col(column), salt))
