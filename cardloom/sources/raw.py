"""Scans of the raw files and their cleaning into model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.functions import clean, crypto
from cardloom.schemas import RAW_COLUMNS

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, columns: list[str], keep_corrupt: bool = False) -> DataFrame:
    """Text columns of a headed CSV, taken by name: column order is free and
    columns not asked for are pruned in the parser. All files of a folder must
    have the same header; a file with another one ends the job."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    names = reader.csv(path).columns
    reader = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    more = [CORRUPT] if keep_corrupt else []
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *more]])
    return reader.schema(schema).csv(path).select(*columns, *more)


def reject_rate(rows: DataFrame) -> DataFrame:
    """One row: lines read, lines that do not fit the schema, share in percent."""
    bad = F.count(CORRUPT)
    return rows.agg(
        F.count(F.lit(1)).alias("lignes"),
        bad.alias("rejets"),
        F.round(100.0 * bad / F.nullif(F.count(F.lit(1)), F.lit(0)), 4).alias("taux_rejet_pct"),
    )


def users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_COLUMNS["users"])


def cards(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_COLUMNS["cards"])


def transactions(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_csv(spark, path, columns or RAW_COLUMNS["transactions"])


def mcc_codes(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object code -> label. Codes have at most four digits, so the file
    is small enough to be one record."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("code", "label"))
    return pairs.select(
        clean.whole(F.col("code")).alias("code_mcc"), clean.text(F.col("label")).alias("libelle_mcc")
    )


def fraud_labels(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object id -> "Yes"/"No" (or true/false, 1/0), bare or below "target".

    As a single JSON record the file could not be split. Read with ',' as line
    separator it can: every record holds at most one entry. Of an id that comes
    twice the last entry holds, as in any JSON object.
    """
    entry = spark.read.option("lineSep", ",").text(path).select(
        "value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    )
    part = lambda i: F.regexp_extract("value", r'"(\d+)"\s*:\s*"?([^",}]*)', i)
    return (
        entry.select(part(1).alias("id"), part(2).alias("label"), "place")
        .where(F.col("id") != "")
        .groupBy(F.col("id").try_cast("bigint").alias("id_transaction"))
        .agg(F.max_by("label", "place").alias("label"))
        .select("id_transaction", clean.yes_no(F.col("label")).alias("is_fraud"))
    )


def clean_users(raw: DataFrame, key: str | None = None) -> DataFrame:
    """Client rows. With a key, address and the three money texts are encrypted
    as they stand; without one they stay in clear."""
    c = F.col
    rows = raw.select(
        clean.whole(c("id"), "bigint").alias("id_client"),
        *[clean.whole(c(n)).alias(n) for n in ("current_age", "retirement_age", "birth_year", "birth_month")],
        clean.text(c("gender")).alias("gender"),
        clean.text(c("address")).alias("address"),
        clean.number(c("latitude"), "decimal(8,5)").alias("latitude"),
        clean.number(c("longitude"), "decimal(9,5)").alias("longitude"),
        *[clean.text(c(n)).alias(n) for n in ("per_capita_income", "yearly_income", "total_debt")],
        clean.whole(c("credit_score")).alias("credit_score"),
        clean.whole(c("num_credit_cards")).alias("num_credit_cards"),
    )
    if key is None:
        return rows
    return crypto.encrypt_columns(rows, ["address", "per_capita_income", "yearly_income", "total_debt"], key)


def clean_cards(raw: DataFrame, key: str | None = None) -> DataFrame:
    """Card rows, card number and CVV encrypted when a key is given."""
    c = F.col
    rows = raw.select(
        clean.whole(c("id"), "bigint").alias("id_carte"),
        clean.whole(c("client_id"), "bigint").alias("id_client"),
        clean.text(c("card_brand")).alias("card_brand"),
        clean.text(c("card_type")).alias("card_type"),
        clean.text(c("card_number")).alias("card_number_enc"),
        clean.text(c("expires")).alias("expires"),
        clean.text(c("cvv")).alias("cvv_enc"),
        clean.yes_no(c("has_chip")).alias("has_chip"),
        clean.whole(c("num_cards_issued")).alias("num_cards_issued"),
        clean.money(c("credit_limit")).alias("credit_limit"),
        clean.mixed_date(c("acct_open_date")).alias("acct_open_date"),
        clean.whole(c("year_pin_last_changed")).alias("year_pin_last_changed"),
        clean.yes_no(c("card_on_dark_web")).alias("card_on_dark_web"),
    )
    return rows if key is None else crypto.encrypt_columns(rows, ["card_number_enc", "cvv_enc"], key)


def clean_transactions(raw: DataFrame, situation_date: Column | None = None) -> DataFrame:
    """Transaction rows. ``situation_date`` is the load day unless given."""
    c = F.col
    return raw.select(
        clean.whole(c("id"), "bigint").alias("id_transaction"),
        clean.whole(c("card_id"), "bigint").alias("id_carte"),
        clean.whole(c("merchant_id"), "bigint").alias("id_marchand"),
        clean.timestamp(c("date")).alias("date_transaction"),
        clean.money(c("amount"), empty="0").alias("amount"),
        clean.text(c("use_chip")).alias("use_chip"),
        (F.current_date() if situation_date is None else situation_date).alias("situation_date"),
    )


def transaction_day() -> Column:
    """Situation date taken from the raw transaction time instead of the load day."""
    return clean.timestamp(F.col("date")).cast("date")


def merchant_fields(raw: DataFrame) -> DataFrame:
    """Input of ``derive.merchants``: the five merchant columns and the id."""
    c = F.col
    return raw.select(
        clean.whole(c("id"), "bigint").alias("id_transaction"),
        clean.whole(c("merchant_id"), "bigint").alias("id_marchand"),
        clean.whole(c("mcc")).alias("code_mcc"),
        *[clean.text(c(n)).alias(n) for n in ("merchant_city", "merchant_state", "zip")],
    )


def error_fields(raw: DataFrame) -> DataFrame:
    """Input of ``derive.error_rows``."""
    return raw.select(
        clean.whole(F.col("id"), "bigint").alias("id_transaction"), clean.text(F.col("errors")).alias("errors")
    )
