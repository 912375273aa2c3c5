"""Mixing sources to target weights.

Method: every row gets a hash-random key; rows are range-sorted by source and
key; running sums of sizes are made per sorted partition and completed by the
sums of the partitions before; each source is cut where its running sum meets
its budget. Whole epochs come first, the cut falls into the last one, and the
row at the cut gives the words that are still missing, so a source's words are
exactly its rounded target.

Cases: a null source is a source of its own, last in order. A null or empty text
has size 0 and is never taken. Rows with the same id and size are told apart by
nothing and may swap their share; with different sizes the smaller comes first.
A null id is a key like others. An empty table gives an empty table. Other
columns are left out by ``shares``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import CHUNK, arrow_schema, map_batches, map_rows, numbered, record_batch, written

#: Weights of the sources by code point, repeating; share of all words that the mix has; most epochs of a source.
WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2

WORD = r"[^ \t-\r]+"


def size_of(text: Column) -> Column:
    """Words of a text, parted by ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def prefix_sums(frame: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Written ``frame`` with ``before``: the sum of ``value`` over the rows of ``group`` that stand earlier in ``order``.

    One range shuffle. What a partition adds to each of its groups is a small
    table (partitions x groups that meet in them), so a group of any size is
    spread over partitions.
    """
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = frame.columns
    at_group, at_value = [names.index(c) for c in group], names.index(value)
    schema = ", ".join(f"`{n}` {t}" for n, t in frame.dtypes) + ", part int, inner long"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                rows = []
                for values in zip(*(c.to_pylist() for c in batch.slice(start, CHUNK).columns), strict=True):
                    key = tuple(values[i] for i in at_group)
                    if key != last:
                        last, total = key, 0
                    rows.append((*values, part, total))
                    total += values[at_value]
                yield record_batch(rows, out)

    ranged = frame.repartitionByRange(max(1, parts), *group, *order).sortWithinPartitions(*group, *order)
    sorted_rows = written(map_batches(ranged, run, schema), name)
    sums = sorted_rows.groupBy(*group, "part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("part").alias("_part"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    same = F.col("part") == F.col("_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return sorted_rows.join(bases, same).withColumn("before", F.col("_base") + F.col("inner")).select(*names, "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source``, ``source_size``, ``target`` of a table (source, source_size) with one row per source.

    A target is level * weight, at most ``epochs`` times the size; the level is
    raised until no uncapped target is above its cap. Each round is one sum over
    the sources, nothing per source reaches the driver.
    """
    last = F.when(F.col("source").isNull(), 1).otherwise(0)
    ranked = prefix_sums(sources.select(last.alias("_null"), "source", "source_size", F.lit(1).cast("long").alias("_one")), [], ["_null", "source"], "_one", "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    rows = ranked.select("source", "source_size", weight.cast("long").alias("_weight"))
    cap = F.col("source_size") * epochs
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        # a source is capped if the present level would give it more than its cap
        full = cap <= F.lit(level) * F.col("_weight") if capped >= 0 else F.lit(False)
        spent, free, n = rows.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)), F.count(F.when(full, 1)),
        ).first()
        if n == capped or not free:
            break
        level, capped = (share * total - spent) / free, n
    return rows.select("source", "source_size", F.least(cap.cast("double"), F.lit(level) * F.col("_weight")).alias("target"))


def shares(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "", row_col: str | None = None, **mix) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of each row.

    ``seed`` changes the random order, which follows from the ids and not from
    where rows lie. ``row_col``, if given, is carried along as ``row`` and parts ties.
    """
    row = [] if row_col is None else ["row"]
    sized = docs.select(
        *([] if row_col is None else [F.col(row_col).alias("row")]),
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("key"),
    )
    ordered = prefix_sums(sized, ["source"], ["key", "doc_id", "size", *row], "size", "mix-order")
    sources = written(ordered.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    per_source = targets(sources, **mix).withColumnRenamed("source", "_source")
    joined = ordered.join(per_source, F.col("source").eqNullSafe(F.col("_source")))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size") - F.col("before")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select(*row, "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", length_col: str | None = None, seed: str = "", **mix) -> DataFrame:
    """The mix itself: a row of ``docs`` for each epoch in which it is taken, with all its columns.

    A row that the cut meets has the first words of its text that still fit, in
    its last epoch only; ``length_col``, if given, is set to its code points.
    """
    rows = numbered(docs, "mix-rows", "_mix_rid")
    part = shares(rows, id_col, source_col, text_col, seed, "_mix_rid", **mix)
    part = part.where("taken > 0").select(*[F.col(c).alias(f"_mix_{c}") for c in ("row", "size", "taken")])
    size, taken, epoch = F.col("_mix_size"), F.col("_mix_taken"), F.col("_mix_epoch")
    joined = rows.join(part, F.col("_mix_rid") == F.col("_mix_row"))
    each = joined.withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((taken - 1) / size))))
    left = F.least(size, taken - epoch * size)
    each = each.select(*[F.col(f"`{c}`") for c in docs.columns], F.when(left < size, left).alias("_mix_words"))
    return _shortened(each, docs, text_col, length_col)


def _shortened(each: DataFrame, docs: DataFrame, text_col: str, length_col: str | None) -> DataFrame:
    word = re.compile(WORD)
    at_text = docs.columns.index(text_col)
    at_length = docs.columns.index(length_col) if length_col else None

    def row(*values):
        *values, words = values
        if words is not None:
            end = next(m.end() for i, m in enumerate(word.finditer(values[at_text]), 1) if i == words)
            values[at_text] = values[at_text][:end]
            if at_length is not None:
                values[at_length] = len(values[at_text])
        return tuple(values)

    return map_rows(each, lambda: row, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes))
