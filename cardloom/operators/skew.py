"""Join of a fact with a dimension: broadcast by checked size, else shuffled, with
care for single keys that hold much of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 4_000_000


def _runtime_split(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(
        conf.get(k, "true").lower() == "true"
        for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def planned_bytes(df: DataFrame) -> int:
    """Size by Spark's own estimate: of files, the bytes on disk after pruning."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _threshold(df: DataFrame) -> int:
    """Spark's broadcast threshold in bytes, whatever unit it was set in."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(*inputs: DataFrame) -> bool:
    """Whether the inputs together are below Spark's broadcast threshold."""
    limit = _threshold(inputs[0])
    return limit > 0 and sum(planned_bytes(df) for df in inputs) <= limit


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: list[str],
    made_from: tuple[DataFrame, ...] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    salted: bool | None = None,
) -> DataFrame:
    """Inner join on ``key``, unique in ``dim``.

    Spark broadcasts a small table by itself, but for a join result its estimate
    is the product of the sides. For a ``dim`` that joins each row of one table
    with one row of another, name the tables in ``made_from``: it is broadcast
    when they fit together.

    Beyond that size both sides are shuffled. With adaptive skew join on, Spark
    splits an over-large partition itself, at no extra pass. Otherwise hot keys
    are salted: a key with n rows is cut into ceil(n / rows_per_slice) slices
    and its dimension row copied once per slice. At most (fact rows /
    rows_per_slice) keys can be hot, which bounds the broadcast list and the copies.
    """
    if salted is None:
        if made_from and fits_broadcast(*made_from):
            return fact.join(F.broadcast(dim), key)
        salted = not _runtime_split(fact)
    if not salted:
        return fact.join(dim, key)
    hot = (
        fact.groupBy(key)
        .agg(F.ceil(F.count(F.lit(1)) / rows_per_slice).cast("int").alias("_slices"))
        .where(F.col("_slices") > 1)
    )
    slices = F.coalesce("_slices", F.lit(1))
    left = fact.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(*spread_by), slices).cast("int")
    )
    right = dim.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    return left.drop("_slices").join(right.drop("_slices"), [key, "_slice"]).drop("_slice")
