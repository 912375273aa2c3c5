from __future__ import annotations

from datetime import datetime, timedelta

from cardloom.streaming import jobs


def test_each_key_once_over_repetitions_and_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "id bigint, date_transaction timestamp"
    start = datetime(2024, 1, 1)

    def add(*ids):
        spark.createDataFrame([(i, start + timedelta(hours=i)) for i in ids], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = jobs.once(jobs.file_stream(spark, source, schema, 1), "id", delay="10 hours")
        with jobs.rocksdb(spark):
            query = jobs.to_files(stream.select("id"), out, checkpoint)
            query.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    before = spark.conf.get(jobs.STATE_STORE)
    add(1, 2, 3, 3)
    add(2, 3, 4)
    assert run() == [1, 2, 3, 4]
    add(3, 4, 5)
    add(5, 5, 6)
    assert run() == [1, 2, 3, 4, 5, 6]
    add(30, 31)
    assert run() == [1, 2, 3, 4, 5, 6, 30, 31]
    # far behind the newest: late, repeated or not
    add(5, 31, 32)
    assert run() == [1, 2, 3, 4, 5, 6, 30, 31, 32]
    assert spark.conf.get(jobs.STATE_STORE) == before
