"""Streaming jobs over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.learning import model
from cardloom.session import scratch_path
from cardloom.sources.binding import event_rows
from cardloom.streaming import jobs
from cardloom.suite import landing
from cardloom.suite.base import Model, money_sql, query, requests_of, time_sql
from cardloom.suite.learned import trained
from cardloom.suite.relational import _REQUEST_SQL, _VALID_SQL


def _stream(m: Model, path: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    schema = m.given("events").schema
    # a stream source takes a folder or a pattern; the pattern fits a single file as well
    source = jobs.file_stream(m.spark, path or f"{m.folder}/{{events.parquet}}", schema, files_per_batch)
    return event_rows(source, "arrived_at")


def _finished(m: Model, name: str, stream: DataFrame) -> DataFrame:
    """Runs the stream over all that is there and reads its output table."""

    def write(path: str) -> None:
        jobs.to_files(stream, path, scratch_path(m.spark, f"{name}-checkpoint")).awaitTermination()

    return m.spark.read.parquet(landing.once(m, name, write))


_WINDOW_SQL = f"""
SELECT {time_sql('debut')} AS debut, {time_sql("debut + INTERVAL 5 MINUTE")} AS fin, categorie, count(*) AS nb_tx,
       {money_sql('sum(cents)')} AS total_amount, CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS nb_fraudes
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, date_transaction) AS debut FROM ev)"""


@query("stream_windows", f"""{_WINDOW_SQL}
WHERE debut + INTERVAL 5 MINUTE <= (SELECT max(date_transaction) FROM ev) - INTERVAL 10 MINUTE
GROUP BY debut, categorie""")
def stream_windows(m: Model):
    """Windows that are final at the end of the stream."""
    return _finished(m, "windows", jobs.windowed(_stream(m), "categorie"))


@query("batch_windows", f"{_WINDOW_SQL} GROUP BY debut, categorie")
def batch_windows(m: Model):
    """The same windows over the table, open ones included."""
    return jobs.windowed(m.events, "categorie")


def _history(m: Model) -> str:
    """Events in files ordered by time, so that a replay meets no late row; at most a million rows a file."""
    events = m.given("events")
    files = max(4, -(-events.count() // 1_000_000))
    return landing.once(
        m, "history", lambda p: events.repartitionByRange(files, "ts").sortWithinPartitions("ts").write.parquet(p)
    )


@query("stream_replay", "SELECT categorie, count(*) AS nb, CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS nb_fraudes FROM ev GROUP BY categorie")
def stream_replay(m: Model):
    """History replayed two files at a time."""
    rows = _finished(m, "replayed", _stream(m, _history(m), 2).select("id_transaction", "categorie", "is_fraud"))
    return rows.groupBy("categorie").agg(
        F.count(F.lit(1)).alias("nb"), F.sum(F.when(F.col("is_fraud"), 1).otherwise(0)).alias("nb_fraudes")
    )


def _scored_stream(m: Model, name: str, path: str | None = None) -> DataFrame:
    events = _stream(m, path)
    fitted = model.load(trained(m))
    return _finished(m, name, jobs.scored(requests_of(events, "arrived_at"), fitted, "id_transaction", "arrived_at"))


@query("stream_scoring", f"SELECT id_transaction FROM {_REQUEST_SQL} r WHERE {_VALID_SQL}")
def stream_scoring(m: Model):
    """Requests scored by the stream: each valid one once."""
    return _scored_stream(m, "scored").select("id_transaction")


@query("stream_latency")
def stream_latency(m: Model):
    """Seconds from the arrival of the newly written history to its scores."""
    return jobs.latency(_scored_stream(m, "scored_history", _history(m)), F.col("arrived_at"))


_ONCE_SQL = "1 / (1 + exp(-(0.0001 * cents - 1)))"


@query("stream_scored_once", f"""
SELECT id_transaction, {_ONCE_SQL} > 0.5 AS is_fraud_predicted, round({_ONCE_SQL}, 4) AS fraud_probability,
       CASE WHEN {_ONCE_SQL} < 0.3 THEN 'LOW' WHEN {_ONCE_SQL} < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level
FROM {_REQUEST_SQL} r WHERE {_VALID_SQL}""")
def stream_scored_once(m: Model):
    """Scores of a source that repeats files, before and after a restart from the checkpoint: each valid request once."""

    def write(out: str) -> None:
        history = m.spark.read.parquet(_history(m))
        seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
        borders = history.select(seconds.cast("double").alias("s")).approxQuantile("s", [0.25, 0.5, 0.75], 0.001)
        quarter = sum([F.when(seconds > b, 1).otherwise(0) for b in borders], F.lit(0))
        source, checkpoint = scratch_path(m.spark, "repeating"), scratch_path(m.spark, "once-checkpoint")
        fitted = model.given_logistic(m.spark, {"amount": 0.01}, -1.0)
        for part in ((0, 1, 0), (1, 2, 2, 3, 3)):
            for k in part:
                history.where(quarter == k).coalesce(1).write.mode("append").parquet(source)
            stream = event_rows(jobs.file_stream(m.spark, source, m.given("events").schema, 1), "arrived_at")
            requests = requests_of(jobs.once(stream, "id_transaction", delay="20 days"), "date_transaction")
            with jobs.rocksdb(m.spark):
                jobs.to_files(jobs.scored(requests, fitted, "id_transaction"), out, checkpoint).awaitTermination()

    rows = m.spark.read.parquet(landing.once(m, "scored_once", write))
    return rows.select("id_transaction", "is_fraud_predicted", "fraud_probability", "risk_level")


@query("latency_of_given_times", """
SELECT count(*) AS nb, round(quantile_cont((id_transaction % 977) / 1000.0::DOUBLE, 0.95), 6) AS p95_s, max((id_transaction % 977) / 1000.0::DOUBLE) AS max_s FROM ev""")
def latency_of_given_times(m: Model):
    """The latency figures on times that follow from the id, so that SQL can tell them."""
    rows = m.events.select(F.col("date_transaction").alias("arrived"), (F.col("date_transaction") + F.make_dt_interval(secs=((F.col("id_transaction") % 977) / 1000).cast("decimal(18,6)"))).alias("predicted_at"))
    return jobs.latency(rows, F.col("arrived")).withColumn("p95_s", F.round("p95_s", 6))
