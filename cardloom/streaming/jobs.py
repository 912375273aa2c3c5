"""Streams of transactions: tumbling windows, scoring, replay, latency."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardloom.learning.model import score
from cardloom.operators.quality import valid_requests

WINDOW = "5 minutes"
LATE = "10 minutes"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream. With ``files_per_batch`` a history is replayed
    in steps of that many files, oldest first. ``arrived_at`` is the time the
    file was written."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select("*", F.col("_metadata.file_modification_time").alias("arrived_at"))


def topic_stream(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """JSON values of a Kafka topic, with the broker's arrival time. Needs the
    Kafka connector on the class path."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    value = F.from_json(F.col("value").cast("string"), schema).alias("v")
    return source.load().select(value, F.col("timestamp").alias("arrived_at")).select("v.*", "arrived_at")


def windowed(stream: DataFrame, *keys: str, window: str = WINDOW, late: str = LATE) -> DataFrame:
    """Volume and frauds per tumbling window and key. Rows later than ``late``
    behind the newest are left out; a window is final once it is that far behind."""
    return (
        stream.withWatermark("date_transaction", late)
        .groupBy(F.window("date_transaction", window).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("nb_tx"),
            F.sum("amount").alias("total_amount"),
            F.sum(F.when(F.col("is_fraud"), 1).otherwise(0)).alias("nb_fraudes"),
        )
        .select(F.col("w.start").alias("debut"), F.col("w.end").alias("fin"), *keys, "nb_tx", "total_amount", "nb_fraudes")
    )


def scored(stream: DataFrame, model: PipelineModel, *keep: str) -> DataFrame:
    """Valid requests of the stream with their score."""
    return score(model, valid_requests(stream), *keep)


def once(stream: DataFrame, key: str, event_time: str = "date_transaction", delay: str = "1 day") -> DataFrame:
    """Each ``key`` once, although the source repeats: the state remembers a key until its time is ``delay`` behind the newest.

    A repetition that comes later than that is late and dropped as such, so it does not come through, either; so
    is a first row that late, which ``delay`` must therefore allow for. The state is bounded by the keys of ``delay``.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, outside the heap; the session's setting comes back afterwards."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def to_files(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Appends to Parquet, each row once. Without interval: all that is there now, then ends.

    ``checkpoint`` must lie in a folder all executors share.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def latency(scores: DataFrame, arrived: Column) -> DataFrame:
    """One row: scored rows, 95th percentile and maximum of seconds from arrival to score.

    ``predicted_at`` is when the micro-batch of the row began; how long the batch
    itself took is in the query's own progress report. Times are cut to whole
    milliseconds, so the exact percentile keeps one count per different value.
    """
    millis = F.unix_millis("predicted_at") - F.unix_millis(arrived)
    return scores.select((millis / 1000).alias("s")).agg(
        F.count(F.lit(1)).alias("nb"),
        F.percentile("s", 0.95).alias("p95_s"),
        F.max("s").alias("max_s"),
    )
