"""Datamarts and summaries.

Facts are aggregated on the fact's own key before any dimension is joined, so a
merchant, card or client that holds a large share of the rows is reduced to one
row per map task ahead of the shuffle and never meets a join as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.exact import half_up_mean, rate_pct
from cardloom.operators.skew import fits_broadcast, spread_join

CARD_METRICS = ("nb_transactions", "total_amount", "nb_fraudes", "taux_fraude_pct")


def is_fraud_count() -> Column:
    """Frauds; a missing label counts as no fraud."""
    return F.sum(F.when(F.col("is_fraud") == "Y", 1).otherwise(0))


def labelled(tx: DataFrame, label: DataFrame) -> DataFrame:
    """Transactions with their 0..1 label."""
    return tx.join(label.select("id_transaction", "is_fraud"), "id_transaction", "left")


def _volume(df: DataFrame, keys: list[str], count_name: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name),
        F.sum("amount").alias("total_amount"),
        F.count("amount").alias("_nb_amounts"),
        is_fraud_count().alias("nb_fraudes"),
    )


def _finished(df: DataFrame, keys: list[str], count_name: str) -> DataFrame:
    return df.select(
        *keys,
        count_name,
        "total_amount",
        half_up_mean(F.col("total_amount"), F.col("_nb_amounts")).alias("avg_amount"),
        "nb_fraudes",
        rate_pct(F.col("nb_fraudes"), F.col(count_name)).alias("taux_fraude_pct"),
    )


def card_datamart(tx: DataFrame, label: DataFrame) -> DataFrame:
    """Per card: volume, amounts, frauds and fraud rate."""
    rows = labelled(tx.select("id_transaction", "id_carte", "amount"), label)
    return _finished(_volume(rows, ["id_carte"], "nb_transactions"), ["id_carte"], "nb_transactions")


def daily_datamart(tx: DataFrame, label: DataFrame) -> DataFrame:
    """Per situation date: volume, amounts, frauds and fraud rate."""
    rows = labelled(tx.select("id_transaction", "situation_date", "amount"), label)
    return _finished(_volume(rows, ["situation_date"], "nb_tx"), ["situation_date"], "nb_tx")


def with_category(rows: DataFrame, mcc: DataFrame) -> DataFrame:
    """Adds the label of ``code_mcc``; the table is broadcast if it is below Spark's threshold."""
    return rows.join(mcc.select("code_mcc", "libelle_mcc"), "code_mcc")


def category_cards(tx: DataFrame, merchant: DataFrame, salted: bool | None = None, **slicing: int) -> DataFrame:
    """Volume per (category code, card).

    A merchant table below the broadcast threshold is joined first, without a
    shuffle; else the fact is reduced to (merchant, card) before it meets it.
    """
    codes = merchant.select("id_marchand", "code_mcc")
    if salted is None and fits_broadcast(merchant):
        return tx.join(F.broadcast(codes), "id_marchand").groupBy("code_mcc", "id_carte").agg(
            F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.count("amount").alias("na")
        )
    pairs = tx.groupBy("id_marchand", "id_carte").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.count("amount").alias("na")
    )
    return (
        spread_join(pairs, codes, "id_marchand", ["id_carte"], salted=salted, **slicing)
        .groupBy("code_mcc", "id_carte")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("na").alias("na"))
    )


def category_datamart(tx: DataFrame, merchant: DataFrame, mcc: DataFrame) -> DataFrame:
    """Per category: volume, amounts and exact number of distinct cards."""
    return category_totals(category_cards(tx, merchant), mcc)


def category_totals(by_card: DataFrame, mcc: DataFrame | None = None) -> DataFrame:
    """Category figures from one row per (category, card). Rows that carry no
    label get it from ``mcc`` at the end, once per category."""
    keys = ["code_mcc"] if mcc is not None else ["code_mcc", "libelle_mcc"]
    totals = by_card.groupBy(*keys).agg(
        F.sum("n").alias("nb_transactions"),
        F.sum("s").cast("decimal(32,2)").alias("total_amount"),
        F.sum("na").alias("_na"),
        F.count("id_carte").alias("nb_cartes_uniques"),
    )
    labelled_totals = totals if mcc is None else with_category(totals, mcc)
    return labelled_totals.select(
        "code_mcc",
        "libelle_mcc",
        "nb_transactions",
        "total_amount",
        half_up_mean(F.col("total_amount"), F.col("_na")).alias("avg_amount"),
        "nb_cartes_uniques",
    )


def client_cards(client: DataFrame, card: DataFrame) -> DataFrame:
    """Per client: cards held, sum of limits (NULL without cards), cards on the dark web."""
    held = card.groupBy("id_client").agg(
        F.count("id_carte").alias("nb_cartes"),
        F.sum("credit_limit").alias("plafond_total"),
        F.sum(F.when(F.col("card_on_dark_web") == "Y", 1).otherwise(0)).alias("nb_cartes_dark_web"),
    )
    return client.join(held, "id_client", "left").select(
        "id_client",
        "current_age",
        "gender",
        "credit_score",
        F.coalesce("nb_cartes", F.lit(0)).alias("nb_cartes"),
        "plafond_total",
        F.coalesce("nb_cartes_dark_web", F.lit(0)).alias("nb_cartes_dark_web"),
    )


def merchant_volume(tx: DataFrame, merchant: DataFrame, mcc: DataFrame) -> DataFrame:
    """Per merchant, idle ones included: count, sum and mean (NULL when idle)."""
    volume = tx.groupBy("id_marchand").agg(
        F.count("id_transaction").alias("nb_transactions"),
        F.sum("amount").alias("montant_total"),
        F.count("amount").alias("_na"),
    )
    return (
        with_category(merchant.join(volume, "id_marchand", "left"), mcc)
        .select(
            "id_marchand",
            "merchant_city",
            "merchant_state",
            "libelle_mcc",
            F.coalesce("nb_transactions", F.lit(0)).alias("nb_transactions"),
            "montant_total",
            half_up_mean(F.col("montant_total"), F.col("_na")).alias("montant_moyen"),
        )
    )


def fraud_categories(tx: DataFrame, label: DataFrame, merchant: DataFrame, mcc: DataFrame) -> DataFrame:
    """Frauds per category label (codes that share a label are merged).

    Starts from the fraud labels, then counts per merchant before the dimension
    join: what is joined is one row per merchant.
    """
    frauds = label.where(F.col("is_fraud") == "Y").select("id_transaction")
    per_merchant = (
        tx.select("id_transaction", "id_marchand", "amount")
        .join(frauds, "id_transaction")
        .groupBy("id_marchand")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"))
    )
    per_code = (
        per_merchant.join(merchant.select("id_marchand", "code_mcc"), "id_marchand")
        .groupBy("code_mcc")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    return (
        with_category(per_code, mcc)
        .groupBy("libelle_mcc")
        .agg(F.sum("n").alias("nb_fraudes"), F.sum("s").alias("montant_fraude"))
    )


def top_cards_of_month(tx: DataFrame, day: Column, k: int = 10) -> DataFrame:
    """Cards with most transactions in the calendar month of ``day``."""
    month = F.col("situation_date").between(F.trunc(day, "MM").cast("date"), F.last_day(day))
    return (
        tx.where(month)
        .groupBy("id_carte")
        .agg(F.count(F.lit(1)).alias("nb_tx"), F.sum("amount").alias("total_amount"))
        .orderBy(F.desc("nb_tx"), "id_carte")
        .limit(k)
    )
