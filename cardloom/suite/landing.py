"""Raw files derived from the model, as input of the load queries.

Written once per session and data folder, below the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.plans import marts
from cardloom.session import scratch_path
from cardloom.sources import tables
from cardloom.sources.binding import Binding

_written: dict[tuple[str, str, str], str] = {}


def once(m: Binding, name: str, write) -> str:
    """Path of a derived file set; ``write(path)`` makes it on first use."""
    key = (m.spark.sparkContext.applicationId, m.folder, name)
    if key not in _written:
        path = scratch_path(m.spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def users(m: Binding) -> str:
    c = m.client
    rows = c.select(
        F.col("id_client").alias("id"), "current_age", "retirement_age", "birth_year", "birth_month", "gender",
        "address", "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt",
        "credit_score", "num_credit_cards",
    )
    return once(m, "users", lambda p: _csv(rows, p))


def cards(m: Binding) -> str:
    k = F.col("id_carte")
    rows = m.carte.select(
        k.alias("id"),
        F.col("id_client").alias("client_id"),
        "card_brand",
        "card_type",
        F.lpad(k.cast("string"), 16, "4").alias("card_number"),
        "expires",
        F.lpad((k % 1000).cast("string"), 3, "0").alias("cvv"),
        F.when(F.col("has_chip") == "Y", "YES").otherwise("NO").alias("has_chip"),
        "num_cards_issued",
        F.concat(F.lit("$"), F.format_number("credit_limit", 2)).alias("credit_limit"),
        F.when(k % 2 == 0, F.date_format("acct_open_date", "MM/yyyy"))
        .otherwise(F.col("acct_open_date").cast("string"))
        .alias("acct_open_date"),
        "year_pin_last_changed",
        F.when(F.col("card_on_dark_web") == "Y", "Yes").otherwise("No").alias("card_on_dark_web"),
    )
    return once(m, "cards", lambda p: _csv(rows, p))


def transactions(m: Binding) -> str:
    """Every eleventh amount is negative, every 29th has no state and zip."""
    return once(m, "transactions", lambda p: _csv(_transaction_lines(m), p))


def faulty_transactions(m: Binding) -> str:
    """The same lines with more: every 53rd comes twice, every 59th again with too many fields."""
    # read three times
    rows = parquet(m, "transaction_lines", _transaction_lines(m))

    def write(path: str) -> None:
        _csv(rows, path)
        _csv(rows.where(F.col("id") % 53 == 0), path, "append")
        broken = rows.where(F.col("id") % 59 == 0).withColumn("errors", F.lit("a,b,c"))
        # without quotes the commas part fields
        broken.write.mode("append").option("header", True).option("quote", "").csv(path)

    return once(m, "faulty_transactions", write)


def _transaction_lines(m: Binding) -> DataFrame:
    i = F.col("id_transaction")
    amount = F.when(i % 11 == 0, -F.col("amount")).otherwise(F.col("amount"))
    with_place = i % 29 != 0
    return (
        m.transaction_with_errors
        .select(
            i.alias("id"),
            F.date_format("date_transaction", "yyyy-MM-dd HH:mm:ss").alias("date"),
            F.col("id_carte").alias("card_id"),
            F.concat(F.lit("$"), F.format_number(amount, 2)).alias("amount"),
            "use_chip",
            F.col("id_marchand").alias("merchant_id"),
            F.concat(F.lit("Ville "), (i % 10).cast("string")).alias("merchant_city"),
            F.when(with_place, F.concat(F.lit("S"), (F.col("id_marchand") % 61).cast("string"))).alias("merchant_state"),
            F.when(with_place, F.lpad(F.col("id_marchand").cast("string"), 9, "0")).alias("zip"),
            (F.col("id_marchand") % 25).alias("mcc"),
            F.nullif("errors", F.lit("")).alias("errors"),
        )
    )


def mcc_codes(m: Binding) -> str:
    """One JSON object; the table holds at most 10 000 codes."""
    entry = F.struct(F.col("code_mcc").cast("string"), F.col("libelle_mcc"))
    text = m.mcc.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    return once(m, "mcc", lambda p: text.coalesce(1).write.text(p))


def labels(m: Binding) -> str:
    """Entries of the label object, split over files as a cluster writes them."""
    answer = F.when(F.col("is_fraud") == "Y", "Yes").otherwise("No")
    text = m.label_fraude.select(
        F.concat(F.lit('"'), F.col("id_transaction").cast("string"), F.lit('": "'), answer, F.lit('",')).alias("value")
    )
    return once(m, "labels", lambda p: text.write.text(p))


def parquet(m: Binding, name: str, df: DataFrame) -> DataFrame:
    """Writes a frame once and reads it back."""
    path = once(m, name, lambda p: df.write.parquet(p))
    spark: SparkSession = m.spark
    return spark.read.parquet(path)


def documents(m, by_id: bool = False) -> DataFrame:
    """Stored documents: laid out for lists of a client, or for lookups by id."""
    if by_id:
        path = once(m, "by_id", lambda p: tables.write_clustered(m.docs, p, "id_transaction"))
    else:
        path = once(m, "by_client", lambda p: tables.write_clustered(m.docs, p, "client.id_client", newest_first=True))
    return tables.read_documents(m.spark, path)


def gold(m) -> str:
    """Folder of the three stored datamarts."""
    t = {"transaction": m.labelled_transaction, "marchand": m.marchand, "mcc": m.mcc}
    return once(m, "gold", lambda p: marts.refresh_all(t, p))


def datamart(m, name: str) -> DataFrame:
    return marts.read(m.spark, gold(m), name)
