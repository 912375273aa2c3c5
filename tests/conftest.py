from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cardloom.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    """Small model tables: one idle card, one client without card, one idle merchant."""
    tx = spark.createDataFrame(
        [
            (1, 10, 100, "2024-01-15 14:30:00", "10.00", "Chip Transaction", "2024-01-15"),
            (2, 10, 100, "2024-01-16 00:00:00", "10.01", "Swipe Transaction", "2024-01-16"),
            (3, 10, 101, "2024-02-01 09:00:00", "-77.00", "Online Transaction", "2024-02-01"),
            (4, 11, 101, "2024-02-02 10:00:00", "0.05", None, "2024-02-02"),
            (5, 12, 100, "2024-02-03 11:00:00", "100.00", "Online Transaction", "2024-02-03"),
        ],
        "id_transaction bigint, id_carte bigint, id_marchand bigint, date_transaction string, amount string, "
        "use_chip string, situation_date string",
    ).selectExpr(
        "id_transaction", "id_carte", "id_marchand", "cast(date_transaction as timestamp) date_transaction",
        "cast(amount as decimal(12,2)) amount", "use_chip", "cast(situation_date as date) situation_date",
    )
    label = spark.createDataFrame([(1, "Y"), (2, "N"), (3, "Y"), (5, "N")], "id_transaction bigint, is_fraud string")
    card = spark.createDataFrame(
        [
            (10, 1, "Visa", "Credit", "Y", "1000.00", "Y"),
            (11, 1, "Visa", "Debit (Prepaid)", "N", None, "N"),
            (12, 2, "Amex", "Credit", "Y", "2000.00", "N"),
            (13, 2, "Amex", "Credit", "Y", "5.00", "Y"),
        ],
        "id_carte bigint, id_client bigint, card_brand string, card_type string, has_chip string, "
        "credit_limit string, card_on_dark_web string",
    ).selectExpr("*", "cast(credit_limit as decimal(12,2)) as l").drop("credit_limit").withColumnRenamed("l", "credit_limit")
    client = spark.createDataFrame(
        [(1, 35, "Female", 700, 2), (2, 64, None, None, 2), (3, 129, "Male", 850, 0)],
        "id_client bigint, current_age int, gender string, credit_score int, num_credit_cards int",
    )
    merchant = spark.createDataFrame(
        [(100, 5411, "Paris", "CA", "75001"), (101, 5812, "Lyon", None, None), (102, 5812, "Nice", "NY", "1")],
        "id_marchand bigint, code_mcc int, merchant_city string, merchant_state string, zip string",
    )
    mcc = spark.createDataFrame([(5411, "Grocery"), (5812, "Food"), (7777, "Food")], "code_mcc int, libelle_mcc string")
    return {
        "transaction": tx, "label_fraude": label, "carte": card, "client": client, "marchand": merchant, "mcc": mcc,
    }


@pytest.fixture(scope="session")
def docs(tiny):
    from cardloom.operators.enrich import enriched, to_documents

    return to_documents(
        enriched(
            tiny["transaction"], tiny["carte"], tiny["client"], tiny["marchand"], tiny["mcc"], tiny["label_fraude"]
        )
    )


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df, *cols: sorted(
        (tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda t: tuple(str(x) for x in t)
    )
