from __future__ import annotations

import base64
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardloom.functions import clean, crypto, exact

KEY = base64.b64encode(bytes(range(32))).decode()
OTHER = base64.b64encode(bytes(range(1, 33))).decode()


def one(spark, values, column):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_yes_no(spark):
    got = one(spark, ["YES", " yes ", "Y", "true", "1", "No", "0", "", None, "oui"], clean.yes_no)
    assert got == ["Y"] * 5 + ["N"] * 5


def test_text_and_numbers(spark):
    assert one(spark, [" a ", "", "  ", None, "nan"], clean.text) == ["a", None, None, None, None]
    assert one(spark, ["66", "66.0", " 7 ", "-3.9", "x", "", None], clean.whole) == [66, 66, 7, -3, None, None, None]
    assert one(spark, ["1.5", "x", None], clean.number) == [1.5, None, None]


def test_money(spark):
    got = one(spark, ["$-77.00", "$1,234.50", "12", "nan", "", None, "$-1,234.50"], clean.money)
    assert got == [Decimal("-77.00"), Decimal("1234.50"), Decimal("12.00"), None, None, None, Decimal("-1234.50")]
    assert one(spark, ["$", None, "x"], lambda x: clean.money(x, empty="0")) == [Decimal("0.00"), None, None]


def test_dates(spark):
    assert one(spark, ["09/2002", "9/2002", "2002-09-17", "soon", None], clean.mixed_date) == [
        date(2002, 9, 1), date(2002, 9, 1), date(2002, 9, 17), None, None,
    ]
    assert one(spark, ["2010-01-01 00:01:00", "2010"], clean.timestamp) == [datetime(2010, 1, 1, 0, 1), None]


def test_mean_rounds_once_and_away_from_zero(spark):
    df = spark.createDataFrame(
        [("0.05", 2), ("-0.05", 2), ("0.04", 3), ("1.00", 3), ("2.00", 3), (None, 0), ("0.00", 0)], "t string, n bigint"
    )
    got = [r[0] for r in df.select(exact.half_up_mean(F.col("t").cast("decimal(22,2)"), F.col("n"))).collect()]
    assert got[:5] == [Decimal("0.03"), Decimal("-0.03"), Decimal("0.01"), Decimal("0.33"), Decimal("0.67")]
    assert got[5:] == [None, None]


def test_rate(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 5), (5, 5), (0, 0), (1, 16000000)], "p bigint, n bigint")
    got = [r[0] for r in df.select(exact.rate_pct(F.col("p"), F.col("n"))).collect()]
    assert got == [Decimal("33.3333"), Decimal("66.6667"), Decimal(0), Decimal(100), None, Decimal(0)]


TEXTS = ["12 rue de l'Église", "été ☂ 😀", "x" * 1000, "75000.5", None, ""]


def test_encryption_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    k, wrong = crypto.key_column(spark, KEY), crypto.key_column(spark, OTHER)
    stored = df.withColumn("c", crypto.encrypted(F.col("t"), k))
    got = stored.select("t", crypto.decrypted(F.col("c"), k).alias("back"), crypto.decrypted_or_null(F.col("c"), wrong).alias("bad")).collect()
    assert [r.back for r in got] == [t or None for t in TEXTS]
    assert all(r.bad is None for r in got)


def test_cipher_layout_and_fresh_nonces(spark):
    df = spark.range(200).select(F.lit("x").alias("lit"), F.col("id"))
    df = df.withColumn("t", F.when(F.col("id") >= 0, "0123456789"))
    c = [r[0] for r in df.select(crypto.encrypted(F.col("t"), crypto.key_column(spark, KEY))).collect()]
    raw = [base64.b64decode(x, validate=True) for x in c]
    assert {len(x) for x in raw} == {12 + 10 + 16}
    assert len({x[:12] for x in raw}) == 200


def test_wrong_key_fails(spark):
    df = spark.range(1).select(crypto.encrypted(F.col("id"), crypto.key_column(spark, KEY)).alias("c"))
    with pytest.raises(Exception):
        df.select(crypto.decrypted(F.col("c"), crypto.key_column(spark, OTHER))).collect()


def test_key_is_not_in_the_plan(spark, capsys):
    df = crypto.encrypt_columns(spark.range(3).withColumn("t", F.col("id").cast("string")), ["t"], KEY)
    df.collect()
    df.explain("extended")
    plan = capsys.readouterr().out
    assert "aes_encrypt" in plan or "redacted" in plan.lower()
    assert KEY not in plan and bytes(range(32)).hex().upper() not in plan.upper().replace(" ", "")


@pytest.mark.parametrize("key", [None, "", "no base64!", base64.b64encode(b"0" * 16).decode()])
def test_bad_keys(key):
    with pytest.raises(ValueError):
        crypto.checked_key(key)


def test_key_from_env(monkeypatch):
    monkeypatch.setenv(crypto.KEY_VARIABLE, KEY)
    assert crypto.key_from_env() == KEY
    monkeypatch.delenv(crypto.KEY_VARIABLE)
    with pytest.raises(ValueError):
        crypto.key_from_env()


def test_pseudonym_is_stable_and_salted(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    a = [r[0] for r in df.select(crypto.pseudonym(F.col("id"), F.lit("s"))).collect()]
    b = [r[0] for r in df.select(crypto.pseudonym(F.col("id"), F.lit("t"))).collect()]
    assert a[0] == a[1] != a[2] and a[0] != b[0]


def test_shared_dir_and_partition_count(spark):
    from cardloom import session

    assert session.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(session.shared_dir(spark)) and not session.path_exists(spark, a)
    assert session.shuffle_partitions_for(10) == 200
    assert session.shuffle_partitions_for(100 * 10**12) > 700_000


def test_cluster_without_shared_dir_is_refused():
    from cardloom import session

    class Conf:
        def get(self, key):
            return None

    class Found:
        def isDefined(self):
            return False

    class Context:
        master = "spark://somewhere"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Found()})()})()

        def getConf(self):
            return Conf()

    with pytest.raises(ValueError):
        session.shared_dir(type("Session", (), {"sparkContext": Context()})())
