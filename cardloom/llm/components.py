"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import written


def components(pairs: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of ``pairs`` (a, b long): ``root`` is the smallest node that links reach.

    Each round lets every node point to its smallest neighbour, shortens the
    pointers to their ends by doubling, and contracts the pairs to those ends,
    until no pair is left; rounds grow with the logarithm of the nodes. All steps
    are joins and minima of written tables, so a node with any number of pairs
    is neither gathered nor sent to the driver.
    """
    pairs = written(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    found: DataFrame | None = None
    while not pairs.isEmpty():
        up = pairs.select(F.col("a").alias("node"), F.col("b").alias("to")).union(pairs.select(F.col("b"), F.col("a")))
        points = up.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to"))
        points = _ends(written(points, "points"))
        found = points if found is None else _followed(found, points)
        a, b = points.select(F.col("node").alias("a"), F.col("to").alias("ra")), points.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        pairs = pairs.join(a, "a").join(b, "b").where("ra <> rb")
        pairs = written(pairs.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "pairs")
    if found is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.select("node", F.col("to").alias("root"))


def _followed(first: DataFrame, then: DataFrame) -> DataFrame:
    """Pointers ``first`` led on by ``then``; where that has none they stay."""
    onward = then.select(F.col("node").alias("to"), F.col("to").alias("_end"))
    return written(first.join(onward, "to", "left").select("node", F.coalesce("_end", "to").alias("to")), "points")


def _ends(points: DataFrame) -> DataFrame:
    while True:
        onward = points.select(F.col("node").alias("to"), F.col("to").alias("_end"))
        next_points = written(points.join(onward, "to").select("node", F.col("_end").alias("to"), (F.col("_end") < F.col("to")).alias("moved")), "points")
        moved = next_points.where("moved").isEmpty()
        points = next_points.drop("moved")
        if moved:
            return points
