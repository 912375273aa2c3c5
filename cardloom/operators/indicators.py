"""Risk indicators for all cards and clients at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the scoring rules.
ALERT_RATE_PCT = 5
RISK_LOW = 0.3
RISK_HIGH = 0.7


def card_rates(card: DataFrame, card_mart: DataFrame) -> DataFrame:
    """Fraud rate of every card, 0 without transactions."""
    rate = card_mart.select("id_carte", F.col("taux_fraude_pct").alias("_rate"))
    zero = F.lit(0).cast("decimal(9,4)")
    return card.join(rate, "id_carte", "left").select(
        card["*"], F.coalesce("_rate", zero).alias("taux_fraude_pct")
    )


def card_alerts(card: DataFrame, card_mart: DataFrame) -> DataFrame:
    """Cards with the alert flag 'Y' from 5 % frauds on."""
    return card_rates(card, card_mart).select(
        "id_carte",
        "taux_fraude_pct",
        F.when(F.col("taux_fraude_pct") >= ALERT_RATE_PCT, "Y").otherwise("N").alias("carte_a_risque"),
    )


def client_risk(client: DataFrame, card: DataFrame, card_mart: DataFrame) -> DataFrame:
    """Risk score 0..100 per client.

    5 x mean of the card rates (each already rounded to 4 digits, idle cards
    count as 0) + 10 per card on the dark web + (850 - credit score) / 10.
    The sum is kept as a fraction over n cards and rounded once, half up.
    """
    held = (
        card_rates(card.select("id_carte", "id_client", "card_on_dark_web"), card_mart)
        .groupBy("id_client")
        .agg(
            F.sum((F.col("taux_fraude_pct") * 10000).cast("bigint")).alias("_rates"),
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.when(F.col("card_on_dark_web") == "Y", 1).otherwise(0)).alias("_dark"),
        )
    )
    rates = F.coalesce("_rates", F.lit(0)).cast("decimal(20,0)")
    n = F.coalesce("_n", F.lit(1)).cast("decimal(20,0)")
    dark = F.coalesce("_dark", F.lit(0)).cast("decimal(20,0)")
    credit = (F.lit(850) - F.coalesce("credit_score", F.lit(850))).cast("decimal(10,0)")
    # score in units of 1/10000, times n
    scaled = rates * 5 + (dark * 100000 + credit * 1000) * n
    half = n * 50
    cents = F.call_function("div", F.abs(scaled) + half, n * 100)
    score = (F.when(scaled < 0, -cents).otherwise(cents)).cast("decimal(18,0)") / 100
    return client.select("id_client", "credit_score").join(held, "id_client", "left").select(
        "id_client", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("decimal(5,2)").alias("score_risque")
    )


def category_label(rows: DataFrame, mcc: DataFrame) -> DataFrame:
    """Adds the label of ``code_mcc``, or a text that names the unknown code."""
    names = mcc.select("code_mcc", F.col("libelle_mcc").alias("_label"))
    fallback = F.concat(F.lit("MCC inconnu ("), F.col("code_mcc").cast("string"), F.lit(")"))
    return rows.join(names, "code_mcc", "left").withColumn(
        "libelle_mcc", F.coalesce("_label", fallback)
    ).drop("_label")


def user_ids(rows: DataFrame, users: DataFrame, login: str = "login") -> DataFrame:
    """Adds ``id_utilisateur`` for a login, whatever its case; 0 when no user or more than one has it."""
    known = users.groupBy(F.upper("login").alias("_login")).agg(F.max("id_utilisateur").alias("_id"), F.count(F.lit(1)).alias("_n"))
    known = known.where(F.col("_n") == 1).drop("_n")
    joined = rows.join(known, F.upper(F.col(login)) == F.col("_login"), "left")
    return joined.withColumn("id_utilisateur", F.coalesce("_id", F.lit(0))).drop("_login", "_id")


def risk_level(probability: Column) -> Column:
    """LOW below 0.3, MEDIUM below 0.7, else HIGH, on the unrounded probability."""
    return F.when(probability < RISK_LOW, "LOW").when(probability < RISK_HIGH, "MEDIUM").otherwise("HIGH")
