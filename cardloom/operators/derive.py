"""Tables derived from raw transactions: merchants, error codes; uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merchants(raw: DataFrame) -> DataFrame:
    """One row per merchant, as on its transaction with the smallest id.

    (File order is no notion of a split file; the transaction id stands for it.)
    """
    seen = F.struct("code_mcc", "merchant_city", "merchant_state", "zip")
    return (
        raw.where(F.col("id_marchand").isNotNull())
        .groupBy("id_marchand")
        .agg(F.min_by(seen, F.col("id_transaction")).alias("m"))
        .select("id_marchand", "m.*")
    )


def error_rows(raw: DataFrame) -> DataFrame:
    """One row per error code of the comma list; blank items drop out.

    The key is id_transaction * 100 + place in the list, so a re-run gives the
    same keys.
    """
    items = raw.where(F.col("errors").isNotNull() & (F.col("errors") != "")).select(
        "id_transaction", F.posexplode(F.split("errors", ",")).alias("_pos", "_code")
    )
    return items.select(
        (F.col("id_transaction") * 100 + F.col("_pos")).alias("id_erreur"),
        "id_transaction",
        F.trim("_code").alias("code_erreur"),
    ).where(F.col("code_erreur") != "")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb")).where(F.col("nb") > 1)


def unique_rows(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by all other columns. Repeats are reduced
    within each map task before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(*df.columns)
