"""Files laid out for several filters at once, and pages found by a directory of files.

**Interleaved layout.** Sorting by one column serves filters on that one. Here the
columns are cut into classes of about equal numbers of rows, and the bits of the
class numbers are interleaved into one key (a space-filling curve). Files and row
groups cover a range of that key, so in each of the columns they cover a part of its
values only, and the minimum and maximum in the file footers let a filter on any of
them skip most. Ids, which have no ranges to speak of, get Bloom filters.

**Page directory.** A table sorted by the order of its pages has, per file, a count;
the sums of the counts before it say which rows the file holds. A page by number
reads the one or two files with its rows, however deep it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.sources.tables import read_documents

#: Bits of a class number, so 2 ** BITS classes per column.
BITS = 6
KEY = "layout_key"


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number that keeps its order."""
    kind = df.select(name).schema[0].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    return F.col(name)


def class_borders(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list]:
    """Upper borders of the classes of each column: at most ``2 ** bits - 1`` numbers a column, from mergeable quantile sketches."""
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    found = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[i] or ())) for i, c in enumerate(columns)}


def interleaved(df: DataFrame, columns: list[str], borders: dict[str, list], bits: int = BITS) -> Column:
    """The key: the bits of all class numbers, the highest of each first. Nulls are in the lowest class."""
    key = F.lit(0).cast("bigint")
    for place, name in enumerate(columns):
        number = F.lit(0)
        for border in borders[name]:
            number = number + F.when(_number(df, name) > F.lit(border), 1).otherwise(0)
        # few classes are spread over all bits, else a column of two values would count in the lowest bit only
        spread = F.lit(2**bits - 1) / F.lit(max(1, len(borders[name])))
        number = F.floor(number * spread).cast("bigint")
        for bit in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(columns) + len(columns) - 1 - place))
    return key


def write_interleaved(df: DataFrame, path: str, columns: list[str], ids: list[str], files: int, rows_per_group: int | None = None) -> None:
    """Writes ``df`` in about ``files`` files along the interleaved key of ``columns``, with Bloom filters for ``ids``.

    ``rows_per_group`` bounds row groups below Parquet's size of 128 MB.
    """
    borders = class_borders(df, columns)
    keyed = df.withColumn(KEY, interleaved(df, columns, borders))
    writer = keyed.repartitionByRange(files, KEY, *ids[:1]).sortWithinPartitions(KEY).drop(KEY).write.mode("overwrite")
    for name in ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.max.bytes#{name}", 1 << 20)
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    writer.parquet(path)


# pages ---------------------------------------------------------------------

#: Order of pages: newest first, ties by id.
_ORDER = ("date_transaction", "id_transaction")


def write_paged(docs: DataFrame, path: str, directory: str, files: int) -> None:
    """Documents sorted by the order of pages over all files, and the directory of the files.

    A date with more rows than a file holds spans several, as the id is part of the
    ranges. Rows without a date come last.
    """
    order = [F.desc_nulls_last(_ORDER[0]), F.asc(_ORDER[1])]
    docs.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    stored = read_documents(docs.sparkSession, path)
    counts = stored.select(*_ORDER, F.col("_metadata.file_name").alias("file")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.max(_ORDER[0]).alias("newest"), F.min_by("id_transaction", F.struct(F.coalesce(-F.unix_micros("date_transaction"), F.lit(2**62)), "id_transaction")).alias("first_id")
    )
    # one row per file
    before = Window.orderBy(F.desc_nulls_last("newest"), "first_id").rowsBetween(Window.unboundedPreceding, -1)
    counts.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).coalesce(1).write.mode("overwrite").parquet(directory)


def numbered_page(spark: SparkSession, path: str, directory: str, number: int, size: int = 20) -> DataFrame:
    """Page ``number`` of all documents; only the files with its rows are read."""
    if number < 1 or not 1 <= size <= 200:
        raise ValueError("page starts at 1, page size is 1..200")
    first = (number - 1) * size
    files = spark.read.parquet(directory)
    hit = files.where((F.col("before") < first + size) & (F.col("before") + F.col("n") > first)).orderBy("before").collect()
    stored = read_documents(spark, path)
    if not hit:
        return stored.limit(0).drop("_ingested_at")
    # at most ``size`` files and one
    rows = spark.read.schema(stored.schema).parquet(*[f"{path}/{r.file}" for r in hit]).drop("_ingested_at")
    return rows.orderBy(F.desc_nulls_last(_ORDER[0]), F.asc(_ORDER[1])).offset(first - hit[0].before).limit(size)
