from __future__ import annotations

import base64
import json
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardloom.functions import crypto
from cardloom.learning import features
from cardloom.operators import datamarts, enrich
from cardloom.plans import lake, load, marts, surface
from cardloom.sources import raw, tables

KEY = base64.b64encode(bytes(range(32))).decode()

USERS = """id,current_age,retirement_age,birth_year,birth_month,gender,address,latitude,longitude,per_capita_income,yearly_income,total_debt,credit_score,num_credit_cards,extra
1,53,66,1966,11,Female,"462 Rose Lane, 2nd",34.15,-117.76,$29278,$59696,$127613,787,5,x
2,53.0,,1966,,,,40.76,-73.74,$37891,,$191349,,5,y
"""
CARDS = """client_id,id,card_brand,card_type,card_number,expires,cvv,has_chip,num_cards_issued,credit_limit,acct_open_date,year_pin_last_changed,card_on_dark_web
1,10,Visa,Debit (Prepaid),4344676511950444,12/2022,623,YES,2,"$24,295",09/2002,2008,No
2,11,Visa,Credit,4956965974959986,12/2020,393,NO,2,,2014-04-05,2014,Yes
"""
TX = """id,date,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors
7,2010-01-01 00:01:00,10,$-77.00,Swipe Transaction,100,Beulah,ND,58523,5499,
8,2010-01-01 00:02:00,10,"$1,014.57",Online Transaction,101,ONLINE,,,5311,"Bad PIN, Technical Glitch"
9,2010-02-01 00:02:00,11,,Swipe Transaction,100,Elsewhere,CA,90001,5499," , Bad CVV,"
"""


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    (d / "users_data.csv").write_text(USERS, encoding="utf-8")
    (d / "cards_data.csv").write_text(CARDS)
    (d / "transactions_data.csv").write_text(TX)
    (d / "mcc_codes.json").write_text(json.dumps({"5499": "Food", "5311": "Food", "1": "Été"}, indent=1))
    (d / "train_fraud_labels.json").write_text(json.dumps({"target": {"7": "No", "8": "Yes"}}))
    return d


@pytest.fixture(scope="module")
def loaded(spark, raw_dir, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("tables"))
    load.run(load.Load(spark, str(raw_dir), target, KEY, raw.transaction_day()))
    return target


def test_every_table_has_its_schema(spark, loaded):
    from pyspark.sql import types as T

    from cardloom.schemas import TABLES

    for name in ("mcc", "client", "carte", "marchand", "transaction", "label_fraude", "erreur_transaction"):
        stored = spark.read.parquet(f"{loaded}/{name}")
        want = T.StructType.fromDDL(TABLES[name])
        got = {f.name: f.dataType for f in stored.schema.fields}
        assert all(got[f.name] == f.dataType for f in want.fields), name


def test_clients(spark, loaded, rows):
    df = tables.read_table(spark, loaded, "client")
    assert rows(df, "id_client", "current_age", "retirement_age", "gender", "credit_score") == [
        (1, 53, 66, "Female", 787), (2, 53, None, None, None),
    ]
    clear = crypto.decrypt_columns(df, ["address", "per_capita_income", "yearly_income"], KEY)
    assert rows(clear, "address", "per_capita_income", "yearly_income") == [
        ("462 Rose Lane, 2nd", "$29278", "$59696"), (None, "$37891", None),
    ]


def test_cards(spark, loaded, rows):
    df = tables.read_table(spark, loaded, "carte")
    assert rows(df, "id_carte", "card_type", "has_chip", "credit_limit", "acct_open_date", "card_on_dark_web") == [
        (10, "Debit (Prepaid)", "Y", D("24295.00"), date(2002, 9, 1), "N"),
        (11, "Credit", "N", None, date(2014, 4, 5), "Y"),
    ]
    assert rows(crypto.decrypt_columns(df, ["card_number_enc", "cvv_enc"], KEY), "card_number_enc", "cvv_enc") == [
        ("4344676511950444", "623"), ("4956965974959986", "393"),
    ]


def test_transactions_merchants_errors_labels(spark, loaded, rows):
    assert rows(spark.read.parquet(f"{loaded}/transaction"), "id_transaction", "amount", "date_transaction", "situation_date", "situation_month") == [
        (7, D("-77.00"), datetime(2010, 1, 1, 0, 1), date(2010, 1, 1), 201001),
        (8, D("1014.57"), datetime(2010, 1, 1, 0, 2), date(2010, 1, 1), 201001),
        (9, None, datetime(2010, 2, 1, 0, 2), date(2010, 2, 1), 201002),
    ]
    assert rows(tables.read_table(spark, loaded, "marchand"), "id_marchand", "code_mcc", "merchant_city", "merchant_state", "zip") == [
        (100, 5499, "Beulah", "ND", "58523"), (101, 5311, "ONLINE", None, None),
    ]
    assert rows(tables.read_table(spark, loaded, "erreur_transaction"), "id_erreur", "code_erreur") == [
        (800, "Bad PIN"), (801, "Technical Glitch"), (901, "Bad CVV"),
    ]
    assert rows(tables.read_table(spark, loaded, "label_fraude"), "id_transaction", "is_fraud") == [(7, "N"), (8, "Y")]
    assert rows(tables.read_table(spark, loaded, "mcc"), "code_mcc", "libelle_mcc") == [(1, "Été"), (5311, "Food"), (5499, "Food")]


def test_months(spark, loaded, rows):
    assert rows(tables.months(spark, f"{loaded}/transaction")) == [("201001", 1), ("201002", 2)]
    df = tables.in_months(spark.read.parquet(f"{loaded}/transaction"), date(2010, 1, 1), date(2010, 1, 31))
    assert df.count() == 2
    assert "PartitionFilters: [isnotnull(situation_month" in df._jdf.queryExecution().toString()


def test_month_overwrite_leaves_other_months(spark, loaded, tmp_path, rows):
    path = str(tmp_path / "m")
    tx = spark.read.parquet(f"{loaded}/transaction").drop("situation_month")
    tables.write_monthly(tx, path)
    tables.write_monthly(tx.where("id_transaction = 7"), path, append_rows=False)
    assert rows(spark.read.parquet(path), "id_transaction") == [(7,), (9,)]


def test_default_situation_date_is_the_load_day(spark, raw_dir):
    got = raw.clean_transactions(raw.transactions(spark, str(raw_dir / "transactions_data.csv")))
    assert got.where(F.col("situation_date") != F.current_date()).count() == 0


def test_label_file_without_wrapper_and_in_splits(spark, tmp_path, rows):
    big = {str(i): "Yes" if i % 7 == 0 else "No" for i in range(1, 20001)}
    path = tmp_path / "labels.json"
    path.write_text(json.dumps(big, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = raw.fraud_labels(spark, str(path))
        # the scan below the reduction to one row per id
        assert spark.read.option("lineSep", ",").text(str(path)).rdd.getNumPartitions() > 3
        assert df.count() == 20000 and df.where("is_fraud = 'Y'").count() == 20000 // 7
        assert df.select("id_transaction").distinct().count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_label_values_of_other_kinds(spark, tmp_path, rows):
    path = tmp_path / "l.json"
    path.write_text('{"1": true, "2": false, "3": 1, "4": 0, "5": null, "6": "yes"}')
    assert rows(raw.fraud_labels(spark, str(path))) == [(1, "Y"), (2, "N"), (3, "Y"), (4, "N"), (5, "N"), (6, "Y")]


def test_csv_prunes_columns(spark, raw_dir):
    plan = raw.transactions(spark, str(raw_dir / "transactions_data.csv"), ["id", "errors"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:string,errors:string>" in plan


def test_unknown_step_is_refused(spark, raw_dir, tmp_path):
    with pytest.raises(ValueError):
        load.run(load.Load(spark, str(raw_dir), str(tmp_path), KEY), ["mcc", "nothing"])


def test_bronze_counts_malformed_rows_and_silver_drops_them(spark, tmp_path, rows):
    path = tmp_path / "t.csv"
    path.write_text(TX + "10,2010-02-02 00:00:00,99,$1.00,Swipe Transaction,100,A,B,1,5499,\n"
                    "7,2010-01-01 00:01:00,10,$-70.00,Swipe Transaction,100,Beulah,ND,58523,5499,\nbroken,line\n")
    bronze_path = str(tmp_path / "bronze")
    lake.to_bronze(spark, str(path), bronze_path, raw.transaction_day())
    bronze = spark.read.parquet(bronze_path)
    r = lake.bronze_report(bronze).first()
    assert (r.lignes, r.rejets) == (6, 1)
    card = spark.createDataFrame([(10,), (11,)], "id_carte bigint")
    merchant = spark.createDataFrame([(100,), (101,)], "id_marchand bigint")
    silver = lake.silver_transactions(bronze, card, merchant)
    # 7 is twice in the file, 9 has no amount, 10 no known card
    assert rows(silver, "id_transaction", "amount") == [(7, D("-77.00")), (8, D("1014.57"))]
    assert rows(lake.silver_transactions(bronze, card, merchant, limit=100), "id_transaction") == [(7,)]


def test_refresh_and_incremental_refresh_agree(spark, tiny, tmp_path, rows):
    full, part = str(tmp_path / "full"), str(tmp_path / "part")
    marts.refresh_all(tiny, full)
    for batch, condition in (("1", "id_transaction <= 2"), ("2", "id_transaction > 2")):
        marts.apply_batch(spark, {**tiny, "transaction": tiny["transaction"].where(condition)}, part, batch)
    # a repeated batch changes nothing
    marts.apply_batch(spark, {**tiny, "transaction": tiny["transaction"].where("id_transaction > 2")}, part, "2")
    for name in ("card", "category"):
        assert rows(marts.read(spark, full, name)) == rows(marts.read(spark, part, name))
    assert marts.read(spark, full, "daily").count() == 5
    with pytest.raises(ValueError):
        marts.refresh("other", tiny, full)


def test_refreshed_days_replace_only_theirs(spark, tiny, tmp_path, rows):
    gold = str(tmp_path)
    marts.refresh_days(tiny, gold, date(2024, 1, 1), date(2024, 2, 1))
    changed = {**tiny, "transaction": tiny["transaction"].withColumn("amount", F.lit(1).cast("decimal(12,2)"))}
    marts.refresh_days(changed, gold, date(2024, 2, 1), date(2024, 2, 28))
    got = rows(spark.read.parquet(f"{gold}/daily_by_day"), "situation_date", "total_amount")
    assert got[0][1] == D("10.00") and got[2:] == [(date(2024, 2, d), D("1.00")) for d in (1, 2, 3)]


def test_erasure(spark, tiny):
    gone = spark.createDataFrame([(1,)], "id_client bigint")
    left = lake.erased(tiny, gone)
    assert {n: left[n].count() for n in ("client", "carte", "transaction", "label_fraude")} == {
        "client": 2, "carte": 2, "transaction": 1, "label_fraude": 1,
    }


def test_sql_functions(spark, tiny):
    users = spark.createDataFrame([(7, "Ada")], "id_utilisateur int, login string")
    surface.register(spark, {**tiny, "utilisateur_si": users})
    r = spark.sql(
        "SELECT fn_calc_taux_fraude_carte(10) a, fn_calc_taux_fraude_carte(13) b, fn_carte_a_risque(10) c, "
        "fn_calc_score_risque_client(2) d, fn_calc_score_risque_client(99) e, fn_get_libelle_mcc(5411) f, "
        "fn_get_libelle_mcc(2) g, fn_get_user_id('ADA') h, fn_get_user_id('x') i"
    ).first()
    assert tuple(r) == (D("66.6667"), D("0.0000"), "Y", D("10.00"), None, "Grocery", "MCC inconnu (2)", 7, 0)
    assert spark.sql("SELECT * FROM fn_transactions_client(1)").count() == 4
    got = spark.sql("SELECT id_carte, fn_carte_a_risque(id_carte) r FROM carte ORDER BY 1").collect()
    assert [x.r for x in got] == ["Y", "N", "N", "N"]


def test_bucketed_tables_join_without_shuffle(spark, tiny, tmp_path, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [
            tables.write_bucketed(tiny[name], f"b_{name}", str(tmp_path / name), "id_transaction", 4)
            for name in ("transaction", "label_fraude")
        ]
        joined = datamarts.labelled(*stored)
        assert joined.count() == 5
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows(datamarts.card_datamart(*stored)) == rows(datamarts.card_datamart(tiny["transaction"], tiny["label_fraude"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clustered_files_do_not_overlap(spark, tmp_path):
    """Ids of the files are disjoint ranges, and one hot client spans several files."""
    import pyarrow.parquet as pq

    path = str(tmp_path / "c")
    i = F.col("id")
    docs = spark.range(20000).select(
        i.alias("id_transaction"), F.timestamp_seconds(i % 977).alias("date_transaction"),
        F.struct(F.when(i % 3 == 0, 7).otherwise(i % 50).alias("id_client")).alias("client"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(docs, path, "id_transaction")
        files = sorted((tmp_path / "c").glob("*.parquet"))
        spans = sorted((t["id_transaction"].to_pylist()[0], t["id_transaction"].to_pylist()[-1]) for t in map(pq.read_table, files))
        assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        tables.write_clustered(docs, path, "client.id_client", newest_first=True)
        hot = [f for f in (tmp_path / "c").glob("*.parquet") if 7 in {c["id_client"] for c in pq.read_table(f)["client"].to_pylist()}]
        assert len(hot) > 1
        assert spark.read.parquet(path).count() == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_label_exchange_is_shared(spark):
    """The transaction and label tables of the binding come from one shuffle."""
    from cardloom.sources.binding import Binding

    m = Binding(spark, "/root/testdata/sf0.001")
    df = datamarts.card_datamart(m.transaction, m.label_fraude)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("l_extendedprice") and final.count("FileScan parquet [l_orderkey") == 1


def test_documents_stored_and_scanned_by_label(spark, docs, tmp_path):
    path = str(tmp_path / "docs")
    tables.write_documents(docs, path, drop_existing=True)
    stored = tables.read_documents(spark, path)
    assert stored.count() == 5
    scan = tables.labelled_documents(stored)
    assert sorted(r.id_transaction for r in scan.collect()) == [1, 2, 3, 5]
    plan = scan._jdf.queryExecution().toString()
    assert "credit_limit" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert features.training_rows(stored).count() == 4
