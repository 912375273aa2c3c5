"""Enriched transactions, flat and as nested documents.

Card and client are joined to each other first, so the fact is shuffled at most
once per foreign key it really carries. No size is assumed for card, client or
merchant: they are broadcast only below ``spark.sql.autoBroadcastJoinThreshold``
and merged as sorted sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.operators.datamarts import labelled, with_category
from cardloom.operators.skew import spread_join

# Allow-lists: nothing else of card and client leaves the relational tables.
CARD_COLUMNS = ["id_carte", "card_brand", "card_type", "has_chip", "credit_limit", "card_on_dark_web"]
CLIENT_COLUMNS = ["id_client", "current_age", "gender", "credit_score", "num_credit_cards"]
MERCHANT_COLUMNS = ["id_marchand", "merchant_city", "merchant_state", "zip"]
TX_COLUMNS = ["id_transaction", "id_carte", "id_marchand", "date_transaction", "amount", "use_chip", "situation_date"]
FLAT_COLUMNS = [
    "id_transaction", "date_transaction", "amount", "use_chip", "situation_date",
    *CARD_COLUMNS, *CLIENT_COLUMNS, *MERCHANT_COLUMNS, "code_mcc", "libelle_mcc", "is_fraud",
]


def card_holder(card: DataFrame, client: DataFrame) -> DataFrame:
    """Cards with their owner, one row per card."""
    owned = card.select(*CARD_COLUMNS, "id_client")
    return spread_join(owned, client.select(*CLIENT_COLUMNS), "id_client", ["id_carte"])


def enriched(
    tx: DataFrame, card: DataFrame, client: DataFrame, merchant: DataFrame, mcc: DataFrame, label: DataFrame | None = None
) -> DataFrame:
    """One flat row per transaction with card, client, merchant, category and label.

    A transaction without card, client, merchant or category is left out; one
    without label stays, with NULL. Without ``label`` the transactions carry ``is_fraud``
    themselves.
    """
    rows = tx.select(*TX_COLUMNS, "is_fraud") if label is None else labelled(tx.select(*TX_COLUMNS), label)
    rows = spread_join(rows, card_holder(card, client), "id_carte", ["id_transaction"], made_from=(card, client))
    rows = spread_join(rows, merchant.select(*MERCHANT_COLUMNS, "code_mcc"), "id_marchand", ["id_transaction"])
    return with_category(rows, mcc).select(*FLAT_COLUMNS)


def first_rows(flat: DataFrame, n: int) -> DataFrame:
    """Row cap of the enriched set, by id so that it is repeatable."""
    return flat.orderBy("id_transaction").limit(n)


def to_documents(flat: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Nested documents: Y/N become booleans, a missing label ``labelled = false``."""
    yes = lambda name: F.col(name) == "Y"
    return flat.select(
        "id_transaction",
        "date_transaction",
        "amount",
        "use_chip",
        "situation_date",
        F.struct(
            "id_carte",
            "card_brand",
            "card_type",
            yes("has_chip").alias("has_chip"),
            "credit_limit",
            yes("card_on_dark_web").alias("card_on_dark_web"),
        ).alias("carte"),
        F.struct(*CLIENT_COLUMNS).alias("client"),
        F.struct(
            "id_marchand",
            F.col("merchant_city").alias("ville"),
            F.col("merchant_state").alias("etat"),
            "zip",
        ).alias("marchand"),
        F.struct(F.col("code_mcc").alias("code"), F.col("libelle_mcc").alias("libelle")).alias("mcc"),
        F.struct(
            yes("is_fraud").alias("is_fraud"), F.col("is_fraud").isNotNull().alias("labelled")
        ).alias("fraude"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
    )


def flatten(docs: DataFrame) -> DataFrame:
    """Documents back to flat rows, flags as Y/N."""
    flag = lambda path: F.when(F.col(path), "Y").when(~F.col(path), "N")
    return docs.select(
        "id_transaction",
        "date_transaction",
        "amount",
        "use_chip",
        "situation_date",
        "carte.id_carte",
        "carte.card_brand",
        "carte.card_type",
        flag("carte.has_chip").alias("has_chip"),
        "carte.credit_limit",
        flag("carte.card_on_dark_web").alias("card_on_dark_web"),
        *[f"client.{c}" for c in CLIENT_COLUMNS],
        "marchand.id_marchand",
        F.col("marchand.ville").alias("merchant_city"),
        F.col("marchand.etat").alias("merchant_state"),
        "marchand.zip",
        F.col("mcc.code").alias("code_mcc"),
        F.col("mcc.libelle").alias("libelle_mcc"),
        flag("fraude.is_fraud").alias("is_fraud"),
    )


def document_datamarts(docs: DataFrame) -> dict[str, DataFrame]:
    """The three datamarts from documents, which carry label and category: no join."""
    from cardloom.operators import datamarts as d

    flat = docs.select(
        "situation_date",
        "amount",
        "carte.id_carte",
        F.col("mcc.code").alias("code_mcc"),
        F.col("mcc.libelle").alias("libelle_mcc"),
        F.when(F.col("fraude.is_fraud"), "Y").alias("is_fraud"),
    )
    by_card = flat.groupBy("code_mcc", "libelle_mcc", "id_carte").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.count("amount").alias("na")
    )
    return {
        "card": d._finished(d._volume(flat, ["id_carte"], "nb_transactions"), ["id_carte"], "nb_transactions"),
        "daily": d._finished(d._volume(flat, ["situation_date"], "nb_tx"), ["situation_date"], "nb_tx"),
        "category": d.category_totals(by_card),
    }
