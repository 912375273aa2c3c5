"""History with validity, from a chain of snapshots.

A snapshot gives a key's attributes on a day. A version begins where they differ
from those on the snapshot before, or where the key was absent on it (gaps and
islands); it ends on the day of the first snapshot that shows something else, or
nothing. Days between snapshots belong to the earlier one. The last version of a
key that the last snapshot still shows has no end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FROM, UNTIL = "valide_du", "valide_au"


def stacked(snapshots: dict[str, DataFrame]) -> DataFrame:
    """Snapshots by their day (text as in 2024-01-31) as one table with the column ``jour``."""
    return reduce(DataFrame.unionByName, [df.withColumn("jour", F.lit(day).cast("date")) for day, df in snapshots.items()])


def versions(rows: DataFrame, key: str, attributes: list[str], days: list[str]) -> DataFrame:
    """``key``, ``attributes``, ``valide_du``, ``valide_au`` (exclusive, null: still so) from stacked snapshots of all ``days``.

    ``days`` names every snapshot, also one without rows. A key that a snapshot lists twice counts once, with its greatest row.
    """
    order = sorted(days)
    number = {d: i for i, d in enumerate(order)}
    # the list of snapshots is bounded, so positions are literals
    position = F.coalesce(*[F.when(F.col("jour") == F.lit(d).cast("date"), F.lit(i)) for d, i in number.items()]) if order else F.lit(0)
    day_of = F.array(*[F.lit(d).cast("date") for d in order]) if order else F.array(F.lit(None).cast("date"))
    seen = rows.groupBy(key, "jour").agg(F.max(F.struct(*attributes)).alias("v")).withColumn("p", position)
    by_key = Window.partitionBy(key).orderBy("p")
    fresh = F.coalesce(F.col("p") != F.lag("p").over(by_key) + 1, F.lit(True)) | ~F.col("v").eqNullSafe(F.lag("v").over(by_key))
    islands = seen.withColumn("fresh", fresh).withColumn("island", F.sum(F.col("fresh").cast("int")).over(by_key))
    spans = islands.groupBy(key, "island").agg(F.min("jour").alias(FROM), F.max("p").alias("last"), F.any_value("v").alias("v"))
    return spans.select(key, "v.*", FROM, F.get(day_of, F.col("last") + 1).alias(UNTIL))


def as_of(history: DataFrame, day: Column) -> DataFrame:
    """The rows that were valid on a day."""
    return history.where((F.col(FROM) <= day) & (F.col(UNTIL).isNull() | (day < F.col(UNTIL)))).drop(FROM, UNTIL)


def joined_as_of(facts: DataFrame, history: DataFrame, key: str, day: str) -> DataFrame:
    """Each fact with the version of its key that was valid on the fact's ``day``; none: nulls.

    An equi join on the key, its range condition inside the join; a fact meets the versions of its own key only.
    """
    h = history.withColumnRenamed(key, "_key")
    valid = (F.col(key) == F.col("_key")) & (F.col(day) >= F.col(FROM)) & (F.col(UNTIL).isNull() | (F.col(day) < F.col(UNTIL)))
    return facts.join(h, valid, "left").drop("_key", FROM, UNTIL)
