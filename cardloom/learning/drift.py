"""Drift of feature distributions between two sets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.learning.features import CATEGORICAL

# Lower edges of the classes per numeric feature; below the first is class -1.
EDGES = {
    "amount": (0, 100, 1000, 10000, 20000, 30000, 40000, 50000, 60000, 80000),
    "hour": (0, 6, 12, 18),
    "current_age": (0, 25, 35, 45, 55, 65),
}
FLOOR = 1e-6


def base_edges(base: DataFrame, names: list[str], classes: int = 10, accuracy: int = 10_000) -> dict[str, tuple]:
    """Lower edges of ``classes`` classes with about equal shares of the base rows, from a mergeable quantile sketch.

    An edge is a value of the base whose rank is off by at most rows / ``accuracy``. Edges that coincide are one, so a
    constant feature has one edge; a feature without values has none.
    """
    shares = F.array(*[F.lit(i / classes) for i in range(1, classes)])
    found = base.agg(*[F.percentile_approx(F.col(n).cast("double"), shares, accuracy).alias(n) for n in names]).first()
    return {n: tuple(sorted(set(found[n] or ()))) for n in names}


def _class(name: str, edges: dict[str, tuple]) -> Column:
    if name in CATEGORICAL:
        return F.coalesce(F.col(name), F.lit(""))
    place = F.lit(-1)
    for i, low in enumerate(edges[name]):
        place = F.when(F.col(name) >= low, i).otherwise(place)
    return place.cast("string")


def _counts(rows: DataFrame, names: list[str], side: str, edges: dict[str, tuple]) -> DataFrame:
    """(feature, classe, rows) with all features counted in one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), _class(n, edges).alias("classe")) for n in names]))
    return rows.select(cells.alias("c")).groupBy("c.feature", "c.classe").agg(F.count(F.lit(1)).alias(side))


def stability_index(base: DataFrame, current: DataFrame, names: list[str], edges: dict[str, tuple] | None = None) -> DataFrame:
    """(feature, psi): sum over classes of (q - p) ln(q / p); empty shares count
    as 1e-6. Joined are class counts, not rows. ``edges`` of the numeric features (default: the fixed ones)."""
    edges = EDGES if edges is None else edges
    both = _counts(base, names, "b", edges).join(_counts(current, names, "c", edges), ["feature", "classe"], "full")
    sums = both.groupBy("feature").agg(F.sum("b").alias("nb"), F.sum("c").alias("nc"))
    share = lambda x, n: F.greatest(F.coalesce(F.col(x), F.lit(0)) / F.col(n), F.lit(FLOOR))
    p, q = share("b", "nb"), share("c", "nc")
    return both.join(sums, "feature").groupBy("feature").agg(
        F.round(F.sum((q - p) * F.ln(q / p)), 6).alias("psi")
    )
