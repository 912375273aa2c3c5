"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from cardloom.session import scratch_path, shipped

#: Rows that stand as Python objects at once inside a task.
CHUNK = 128
#: Arrow batches sent to Python end at this size, however long the texts are.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a table in the shared folder: computed once, its lineage cut, readable after executors are lost."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(frame: DataFrame, name: str, column: str = "rid") -> DataFrame:
    """Written table with a number per row. The number is fixed by the write, so rows stay apart even if all else is equal."""
    return written(frame.withColumn(column, F.monotonically_increasing_id()), name)


def python_ready(spark: SparkSession) -> None:
    """Readies a session for Python in tasks: Arrow batches of bounded size, and this package on the executors."""
    shipped(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def map_batches(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    python_ready(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def map_rows(frame: DataFrame, factory: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """One row out for each row in.

    ``factory`` runs once in each task and gives the function of a row's values;
    at most ``CHUNK`` rows are Python objects at a time.
    """
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = factory()
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                yield record_batch([row(*values) for values in zip(*(c.to_pylist() for c in part.columns), strict=True)], out)

    return map_batches(frame, run, schema)


def struct_of(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(struct_of(schema))


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_built: dict[tuple[str, str], object] = {}


class Shared:
    """A broadcast value of bounded size, and what each Python worker builds from it once."""

    def __init__(self, spark: SparkSession, value):
        self.data = spark.sparkContext.broadcast(value)
        self.name = uuid.uuid4().hex

    @property
    def value(self):
        return self.data.value

    def built(self, what: str, make: Callable):
        if (self.name, what) not in _built:
            _built.clear()
            _built[self.name, what] = make(self.value)
        return _built[self.name, what]
