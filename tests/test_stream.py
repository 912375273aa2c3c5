from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cardloom.streaming import jobs

SCHEMA = "id_transaction bigint, date_transaction timestamp, amount decimal(12,2), is_fraud boolean, categorie string"


def source(spark, path, offsets, first_id=0):
    t0 = datetime(2024, 1, 1)
    data = [(first_id + i, t0 + timedelta(minutes=m), 1, i % 2 == 0, "a") for i, m in enumerate(offsets)]
    spark.createDataFrame(data, "id_transaction bigint, date_transaction timestamp, amount int, is_fraud boolean, categorie string").withColumn(
        "amount", F.col("amount").cast("decimal(12,2)")
    ).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out, per_batch=None):
    stream = jobs.windowed(jobs.file_stream(spark, path, SCHEMA, per_batch), "categorie")
    jobs.to_files(stream, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out)


def test_closed_windows_equal_batch(spark, tmp_path, rows):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    source(spark, path, [0, 1, 4, 5, 9, 10, 31])
    got = rows(run(spark, path, out), "debut", "nb_tx", "nb_fraudes")
    batch = jobs.windowed(spark.read.schema(SCHEMA).parquet(path), "categorie")
    assert got == rows(batch.where("fin <= timestamp '2024-01-01 00:21:00'"), "debut", "nb_tx", "nb_fraudes")
    assert [g[1] for g in got] == [3, 2, 1]


def test_restart_goes_on_and_late_rows_are_left_out(spark, tmp_path, rows):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    source(spark, path, [0, 1, 31])
    run(spark, path, out)
    source(spark, path, [2, 32, 61], first_id=100)
    got = rows(run(spark, path, out), "debut", "nb_tx")
    assert got == [(datetime(2024, 1, 1), 2), (datetime(2024, 1, 1, 0, 30), 2)]


def test_latency(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 00:00:10' AS predicted_at, timestamp '2024-01-01 00:00:08.5' AS a")
    r = jobs.latency(df, F.col("a")).first()
    assert (r.nb, r.p95_s, r.max_s) == (1, 1.5, 1.5)
