"""Filter interaction audit.

Method: each filter has a table of the ids that fail it. What a filter removes
after a prefix of others is its own table left after anti joins with theirs; what
it would have removed, but an earlier filter did, is what the semi join with the
last of them adds; who is still there after a prefix is the table of all ids left
after anti joins. Figures of a step depend on the set of earlier filters only, so
the prefixes of all orders come down to their sets. Counts carry the label
losses.

All joins are on a row's own number, which is unique, over narrow tables; the
tables of one filter are shuffled (or broadcast by Spark, below its threshold)
once and used by every set. Rows that agree in id, part and outcome are one row
with a count before any join, so a repeated row is as cheap as one.

Cases: a null text is read as empty. A null id is a row like others, with no
label and no smaller id. An id that repeats is counted row by row; equal texts
under one id are no copies of a smaller id. Where an id has several labels, one
that says 1 decides. A null part and an empty one are the same part. Other
columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import numbered, written

WORD = r"[^ \t-\r]+"


def conditions(text: Column) -> dict[str, Column]:
    """The filters that a text decides by itself; E, copies of a smaller id's text, needs the table."""
    found = F.regexp_extract_all(text, F.lit(WORD), 0)
    words, distinct = F.size(found), F.size(F.array_distinct(found))
    return {
        "A": words < 200,
        "B": 100 * distinct < 50 * words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def outcomes(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Written rows ``unit, part, n, good, toxic, A..E``: ``n`` documents that agree in all of them and in their id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    marked = read.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(n) for n, c in conditions(F.col("text")).items()])
    units = numbered(marked.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("n")), "audit-units", "unit")

    # the key of the anti join holds the id, so a text with any number of copies is spread
    first = units.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    copies = units.where("id is not null").select("unit", "id", "digest").join(first, ["digest", "id"], "left_anti").select("unit", F.lit(True).alias("E"))
    known = (
        labels.select(F.col("doc_id").alias("id"), "quality", "toxic").where("id is not null and (quality = 1 or toxic = 1)")
        .groupBy("id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    return units.drop("digest").join(copies, "unit", "left").join(known, "id", "left").select(
        "unit", "part", "n", *[(F.col("n") * F.coalesce(F.col(c), F.lit(False)).cast("long")).alias(c) for c in ("good", "toxic")],
        "A", "B", "C", "D", F.coalesce("E", F.lit(False)).alias("E"),
    )


def subsets(names: list[str]) -> Iterator[tuple[str, ...]]:
    """Sets of ``names`` in their order, the shorter before what extends them."""
    for mask in range(1 << len(names)):
        yield tuple(n for i, n in enumerate(names) if mask >> i & 1)


def prefix_counts(every: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """Written counts per part and set of earlier filters: ``what`` is a filter (what it removes after them), a filter
    with ``+`` (what the last of them took from it), or ``kept``.

    ``every`` and ``failing[f]`` hold ``unit, part, n, good, toxic``, one row per unit. Filter by filter each row is
    doubled, as its sets are those without and those with the filter, and the anti join thins out the second; so all
    sets of all filters go through one join per filter.
    """
    left = every.withColumn("what", F.lit("kept"))
    for f, table in failing.items():
        left = left.unionByName(table.withColumn("what", F.lit(f)))
    left = left.withColumn("earlier", F.lit(""))
    counted: DataFrame | None = None
    for g, table in failing.items():
        ids = table.select(F.col("unit").alias("fails"))
        taken = left.where(~F.col("what").isin(g, "kept")).join(ids, F.col("unit") == F.col("fails"), "left_semi")
        taken = taken.withColumn("earlier", F.concat("earlier", F.lit(g))).withColumn("what", F.concat("what", F.lit("+")))
        sets = F.when(F.col("what") == g, F.array(F.lit(""))).otherwise(F.array(F.lit(""), F.lit(g)))
        doubled = left.withColumn("with", F.explode(sets))
        kept = doubled.join(ids, (F.col("unit") == F.col("fails")) & (F.col("with") == g), "left_anti")
        left = kept.withColumn("earlier", F.concat("earlier", "with")).drop("with")
        counted = taken if counted is None else counted.unionByName(taken)
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    return written(counted.unionByName(left).groupBy("part", "earlier", "what").agg(*sums), "audit-counts")


def audit(every: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step, zeros included: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``."""
    spark = every.sparkSession
    names = list(failing)
    k = len(names)
    counts = prefix_counts(every, failing)

    # bounded lists, known from the number of filters: which figures a set of earlier filters needs, and the steps of all orders
    figures = []
    for f in names:
        others = [g for g in names if g != f]
        for earlier in subsets(others):
            key = "".join(earlier)
            # all parts have this one, so each has every row, with zeros where nothing fails
            figures.append((f, key, "", "kept", "kept", 0))
            figures.append((f, key, "".join(g for g in names if g == f or g in earlier), "kept", "kept", 1))
            figures.append((f, key, key, f, "removed", 1))
            figures += [(f, key, "".join(earlier[: i + 1]), f"{f}+", "redundant", 1) for i in range(len(earlier))]
            figures.append((f, key, "".join(others), f, "unique_fails", 1))
            figures += [(f, key, "".join(s), f, "shapley", factorial(len(s)) * factorial(k - 1 - len(s))) for s in subsets(others)]
    needs = spark.createDataFrame(figures, "filter string, prefix string, earlier string, what string, figure string, weight long")
    orders = [("".join(o), i + 1, o[i], "".join(g for g in names if g in o[:i])) for o in permutations(names) for i in range(k)]
    steps = spark.createDataFrame(orders, "filter_order string, step int, filter string, prefix string")

    def total(figure: str, value: str = "n", name: str | None = None) -> Column:
        return F.sum(F.when(F.col("figure") == figure, F.col(value) * F.col("weight")).otherwise(0)).cast("long").alias(name or figure)

    by_set = counts.join(F.broadcast(needs), ["earlier", "what"]).groupBy("part", "filter", "prefix").agg(
        total("kept"), total("removed"), total("redundant"), total("unique_fails"),
        total("removed", "good", "good_lost"), total("removed", "toxic", "toxic_lost"), total("shapley"),
    )
    return by_set.join(F.broadcast(steps), ["filter", "prefix"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def interactions(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the five filters over whole documents."""
    rows = written(outcomes(docs, labels, **columns), "audit-outcomes")
    every = rows.select("unit", "part", "n", "good", "toxic")
    failing = {f: written(rows.where(f).select(*every.columns), f"fails-{f}") for f in "ABCDE"}
    return audit(every, failing)
