"""Every registered query with SQL against DuckDB on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_equals_sql(spark, db, name):
    problem, _, _ = compare(spark, db, name, driver.queries()[name], driver.oracle_sql()[name], FOLDER)
    assert problem is None, problem


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.columns[0] == "id_carte"


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_one_fraud_rate_below_whole(spark):
    r = driver.queries()["fraud_stats"](spark, FOLDER).first()
    assert 0 < r.nb_fraudes < r.total_transactions
