"""Parquet tables: scans, appends, monthly partitions, documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.schemas import DOCUMENT, TABLES

MONTH = "situation_month"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Model table with its fixed schema; no file is opened to infer it."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_column: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """Table of a relational store, read by ``parts`` tasks over id ranges."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_column, lowerBound=lower, upperBound=upper,
        numPartitions=parts, fetchsize=10000, **options,
    )
    return reader.load()


def typed(df: DataFrame, name: str) -> DataFrame:
    """Columns of the model in their order and type, absent ones NULL."""
    have = set(df.columns)
    fields = T.StructType.fromDDL(TABLES[name]).fields
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def append(df: DataFrame, path: str) -> None:
    """Appends rows. The commit is per job: a failed job leaves nothing behind."""
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Catalog table hashed and sorted by ``key`` into ``buckets`` (one file each).

    Tables bucketed alike on a key are joined on it without a shuffle. About a
    bucket per few million rows keeps a bucket within one task's memory.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def with_month(tx: DataFrame) -> DataFrame:
    """Adds the month as a whole number, 199803 for March 1998."""
    return tx.withColumn(MONTH, F.year("situation_date") * 100 + F.month("situation_date"))


def write_monthly(tx: DataFrame, path: str, append_rows: bool = True) -> None:
    """Writes into month partitions; with ``append_rows=False`` the months
    present are replaced and the others stay.

    The rebalance hint gathers each month's rows into few files. Where a month
    is large (a whole load lands in one by default, since the situation date is
    the load day) adaptive execution splits it over many tasks again.
    """
    writer = with_month(tx).hint("rebalance", MONTH).write.partitionBy(MONTH)
    if append_rows:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def months(spark: SparkSession, path: str) -> DataFrame:
    """Partition catalogue with positions. Reads directory names and file
    footers, no column data; there is one entry per calendar month."""
    found = spark.read.parquet(path).select(MONTH).distinct()
    ordered = found.select(F.col(MONTH).cast("string").alias("m")).agg(F.array_sort(F.collect_list("m")).alias("m"))
    return ordered.select(F.posexplode("m").alias("p", "partition_name")).select(
        "partition_name", (F.col("p") + 1).alias("partition_position")
    )


def in_months(df: DataFrame, first_day: date, last_day: date) -> DataFrame:
    """Date range that prunes month partitions as well as row groups."""
    number = lambda d: d.year * 100 + d.month
    return df.where(
        F.col(MONTH).between(number(first_day), number(last_day))
        & F.col("situation_date").between(F.lit(first_day), F.lit(last_day))
    )


def write_documents(docs: DataFrame, path: str, drop_existing: bool = False) -> None:
    docs.write.mode("overwrite" if drop_existing else "append").parquet(path)


def write_clustered(docs: DataFrame, path: str, *keys: str, newest_first: bool = False) -> None:
    """Documents laid out for filters on ``keys`` (dotted names reach into structs).

    Ranges are cut by the keys and the date, so a key with many rows spans
    several files; the files' min/max then let a filter skip the others. By
    ``id_transaction`` this serves point lookups, by ``client.id_client`` with
    ``newest_first`` the list of a client.
    """
    order = [F.col(k) for k in keys] + ([F.desc("date_transaction")] if newest_first else [])
    ranges = [*keys, "date_transaction"] if newest_first else list(keys)
    docs.repartitionByRange(*ranges).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).parquet(path)


def labelled_documents(docs: DataFrame) -> DataFrame:
    """Training scan: rows flagged as labelled (either name), needed fields only."""
    fields = {name for name in docs.schema["fraude"].dataType.names}
    flags = [F.col(f"fraude.{n}") for n in ("labelled", "is_labellisee") if n in fields]
    condition = flags[0] if len(flags) == 1 else F.coalesce(flags[0], F.lit(False)) | F.coalesce(flags[1], F.lit(False))
    keep = [c for c in ("id_transaction", "amount", "use_chip", "date", "date_transaction") if c in docs.columns]
    merchant = docs.schema["marchand"].dataType.names
    return docs.where(condition).select(
        *keep,
        F.struct("client.current_age", "client.gender").alias("client"),
        F.struct(*[f"marchand.{n}" for n in ("etat", "state") if n in merchant]).alias("marchand"),
        F.struct("mcc.code").alias("mcc"),
        F.struct(*[f"fraude.{n}" for n in ("labelled", "is_labellisee", "is_fraud") if n in fields]).alias("fraude"),
    )
