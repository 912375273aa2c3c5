"""Exact distinct cards per category as bitmaps that merge.

A bitmap holds 32 768 card numbers in 4 KB, wherever they fall. Batches are reduced
to bitmaps within each task, and a stored bitmap takes a batch in by a bitwise or;
the number of distinct cards is the number of bits. Repeated cards and repeated
batches change nothing. The table is cut by (category, bitmap number): a batch reads
and writes only the parts that its cards fall into. Cards do not leave; where rows
are deleted, ``deltas`` counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.sources.versions import Versions


def table(spark: SparkSession, root: str, parts: int = 64) -> Versions:
    return Versions(spark, root, T.StructType.fromDDL("code_mcc int, number bigint, cards binary"), ("code_mcc", "number"), parts)


def of_batch(tx: DataFrame, merchant: DataFrame) -> DataFrame:
    """Bitmaps of the cards seen per category; rows without a card or a known category tell nothing."""
    coded = tx.select("id_marchand", F.col("id_carte").cast("bigint").alias("card")).where("card is not null")
    rows = coded.join(merchant.select("id_marchand", F.col("code_mcc").cast("int").alias("code_mcc")).where("code_mcc is not null"), "id_marchand")
    return rows.groupBy("code_mcc", F.bitmap_bucket_number("card").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("card")).alias("cards"))


def merge(stored: Versions, batch: str, bitmaps: DataFrame) -> list[int]:
    """Takes a batch's bitmaps in; returns the parts written."""
    parts = stored.touched(bitmaps)
    if parts:
        both = stored.read(before=batch, parts=parts).unionByName(bitmaps)
        stored.write(both.groupBy("code_mcc", "number").agg(F.bitmap_or_agg("cards").alias("cards")), batch, parts)
    return parts


def distinct_cards(stored: Versions) -> DataFrame:
    return stored.read().groupBy("code_mcc").agg(F.sum(F.bitmap_count("cards")).cast("bigint").alias("nb_cartes_uniques"))
