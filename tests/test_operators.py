from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cardloom.operators import audit, datamarts, derive, enrich, indicators, listing, quality
from cardloom.operators.skew import spread_join
from cardloom.schemas import SECRET_COLUMNS


def facts(t):
    return t["transaction"], t["label_fraude"]


def test_card_datamart(tiny, rows):
    assert rows(datamarts.card_datamart(*facts(tiny))) == [
        (10, 3, D("-56.99"), D("-19.00"), 2, D("66.6667")),
        (11, 1, D("0.05"), D("0.05"), 0, D("0.0000")),
        (12, 1, D("100.00"), D("100.00"), 0, D("0.0000")),
    ]


def test_daily_datamart(tiny, rows):
    got = rows(datamarts.daily_datamart(*facts(tiny)))
    assert len(got) == 5 and got[0] == (date(2024, 1, 15), 1, D("10.00"), D("10.00"), 1, D("100.0000"))


def test_category_datamart(tiny, rows):
    got = rows(datamarts.category_datamart(tiny["transaction"], tiny["marchand"], tiny["mcc"]))
    assert got == [
        (5411, "Grocery", 3, D("120.01"), D("40.00"), 2),
        (5812, "Food", 2, D("-76.95"), D("-38.48"), 2),
    ]


def test_client_cards_keeps_clients_without_cards(tiny, rows):
    assert rows(datamarts.client_cards(tiny["client"], tiny["carte"])) == [
        (1, 35, "Female", 700, 2, D("1000.00"), 1),
        (2, 64, None, None, 2, D("2005.00"), 1),
        (3, 129, "Male", 850, 0, None, 0),
    ]


def test_merchant_volume_keeps_idle_merchants(tiny, rows):
    got = rows(datamarts.merchant_volume(tiny["transaction"], tiny["marchand"], tiny["mcc"]))
    assert got[2] == (102, "Nice", "NY", "Food", 0, None, None)
    assert got[1] == (101, "Lyon", None, "Food", 2, D("-76.95"), D("-38.48"))


def test_fraud_categories_merge_equal_labels(tiny, rows, spark):
    merchant = tiny["marchand"].withColumn("code_mcc", F.when(F.col("id_marchand") == 100, 7777).otherwise(F.col("code_mcc")))
    got = rows(datamarts.fraud_categories(*facts(tiny), merchant, tiny["mcc"]))
    assert got == [("Food", 2, D("-67.00"))]


def test_top_cards_of_month(tiny, rows):
    got = datamarts.top_cards_of_month(tiny["transaction"], F.lit(date(2024, 2, 10)), 2).collect()
    assert [r.id_carte for r in got] == [10, 11]


def test_document_shape_and_minimisation(docs):
    from pyspark.sql import types as T

    from cardloom.schemas import DOCUMENT

    assert docs.columns == T.StructType.fromDDL(DOCUMENT).names
    text = docs._jdf.schema().treeString()
    assert not any(c in text for c in SECRET_COLUMNS)
    by_id = {r.id_transaction: r for r in docs.collect()}
    assert by_id[4].fraude.labelled is False and by_id[4].fraude.is_fraud is None
    assert by_id[1].fraude.is_fraud is True and by_id[2].fraude.is_fraud is False
    assert by_id[1].carte.has_chip is True and by_id[1].marchand.etat == "CA"


def test_documents_flatten_back(docs, tiny, rows):
    flat = enrich.enriched(
        tiny["transaction"], tiny["carte"], tiny["client"], tiny["marchand"], tiny["mcc"], tiny["label_fraude"]
    )
    assert rows(enrich.flatten(docs)) == rows(flat)


def test_document_datamarts_agree(docs, tiny, rows):
    marts = enrich.document_datamarts(docs)
    assert rows(marts["card"]) == rows(datamarts.card_datamart(*facts(tiny)))
    assert rows(marts["daily"]) == rows(datamarts.daily_datamart(*facts(tiny)))
    assert rows(marts["category"]) == rows(datamarts.category_datamart(tiny["transaction"], tiny["marchand"], tiny["mcc"]))


def test_filters(docs):
    ids = lambda **k: sorted(r.id_transaction for r in docs.where(listing.transaction_filter(**k)).collect())
    assert ids() == [1, 2, 3, 4, 5]
    assert ids(id_client=1) == [1, 2, 3, 4]
    assert ids(is_fraud=False) == [2, 5]
    assert ids(is_fraud=True, id_carte=10) == [1, 3]
    assert ids(code_mcc=5812) == [3, 4]
    assert ids(date_from=datetime(2024, 1, 16), date_to=datetime(2024, 2, 2, 10)) == [2, 3, 4]


def test_pages(docs):
    everything = listing.transaction_filter()
    first = listing.page(docs, everything, 1, 2).collect()
    second = listing.page(docs, everything, 2, 2).collect()
    assert [r.id_transaction for r in first + second] == [5, 4, 3, 2]
    last = first[-1]
    keyset = listing.page_after(docs, everything, last.date_transaction, last.id_transaction, 2).collect()
    assert [r.id_transaction for r in keyset] == [3, 2]
    assert "_ingested_at" not in first[0].asDict()
    with pytest.raises(ValueError):
        listing.page(docs, everything, 0)


def test_lookup(docs):
    assert listing.find_transaction(docs, 3).count() == 1
    assert listing.find_transaction(docs, 999).count() == 0
    assert listing.one_fraud(docs).first().id_transaction == 1


def test_client_summary_has_zero_rows(docs, spark, rows):
    wanted = spark.createDataFrame([(1,), (3,), (99,)], "id_client bigint")
    assert rows(listing.client_summary(docs, wanted)) == [
        (1, 4, D("-56.94"), 2, 2),
        (3, 0, D("0.00"), 0, 0),
        (99, 0, D("0.00"), 0, 0),
    ]
    assert listing.total(docs, listing.transaction_filter(id_client=1)).first().total == 4


def test_fraud_stats_and_facets(docs):
    s = listing.fraud_stats(docs).first()
    assert (s.total_transactions, s.nb_fraudes, s.taux_global_pct) == (5, 2, D("40.0000"))
    assert s.par_genre == {"Female": 2}
    assert s.par_type_paiement == {"Chip Transaction": 1, "Online Transaction": 1}
    facets = listing.fraud_facets(docs).collect()
    for name in ("par_genre", "par_tranche_age", "par_type_paiement"):
        assert sum(r.nb for r in facets if r.facet == name) == s.nb_fraudes


def test_fraud_stats_of_nothing(docs):
    s = listing.fraud_stats(docs.where("id_transaction < 0")).first()
    assert (s.total_transactions, s.nb_fraudes, s.taux_global_pct, s.par_genre) == (0, 0, D("0.0000"), {})


def test_blank_and_missing_facet_keys_are_one(docs):
    some = docs.withColumn("use_chip", F.when(F.col("id_transaction") == 1, "").when(F.col("id_transaction") == 3, None))
    assert listing.fraud_stats(some).first().par_type_paiement == {"Unknown": 2}


def test_age_class(spark):
    df = spark.createDataFrame([(0,), (24,), (25,), (64,), (65,), (129,), (130,), (-1,), (None,)], "a int")
    got = [r[0] for r in df.select(listing.age_class(F.col("a"))).collect()]
    assert got == ["0", "0", "25", "55", "65", "65", "unknown", "unknown", "unknown"]


def test_ranked_cards(tiny):
    mart = datamarts.card_datamart(*facts(tiny))
    assert [r.id_carte for r in listing.ranked_cards(mart, "total_amount", limit=2).collect()] == [12, 11]
    assert [r.id_carte for r in listing.ranked_cards(mart, "taux_fraude_pct", min_transactions=2).collect()] == [10]
    with pytest.raises(ValueError):
        listing.ranked_cards(mart, "id_carte; drop")


def test_latest_per_client_limits_before_the_shuffle(docs, capsys):
    df = listing.latest_per_client(docs, 2)
    assert sorted((r.id_client, r.id_transaction) for r in df.collect()) == [(1, 3), (1, 4), (2, 5)]
    df.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_rates_alerts_and_risk(tiny, rows):
    mart = datamarts.card_datamart(*facts(tiny))
    alerts = rows(indicators.card_alerts(tiny["carte"], mart))
    assert [(a[0], a[2]) for a in alerts] == [(10, "Y"), (11, "N"), (12, "N"), (13, "N")]
    # client 1: mean(66.6667, 0) * 5 + 10 + 15 = 191.67 -> 100; client 2: 0 + 10 + 0; client 3: no card
    assert rows(indicators.client_risk(tiny["client"], tiny["carte"], mart)) == [
        (1, D("100.00")), (2, D("10.00")), (3, D("0.00")),
    ]


def test_risk_averages_rounded_rates(spark):
    client = spark.createDataFrame([(1, 843)], "id_client bigint, credit_score int")
    card = spark.createDataFrame([(1, 1, "N"), (2, 1, "N"), (3, 1, "N")], "id_carte bigint, id_client bigint, card_on_dark_web string")
    mart = spark.createDataFrame([(1, "0.0013")], "id_carte bigint, t string").select("id_carte", F.col("t").cast("decimal(9,4)").alias("taux_fraude_pct"))
    # 5 * 0.0013 / 3 + 0.7 = 0.70216...
    assert indicators.client_risk(client, card, mart).first().score_risque == D("0.70")


def test_category_label_and_user_ids(spark, tiny, rows):
    codes = spark.createDataFrame([(5411,), (1,)], "code_mcc int")
    assert rows(indicators.category_label(codes, tiny["mcc"])) == [(1, "MCC inconnu (1)"), (5411, "Grocery")]
    users = spark.createDataFrame([(7, "Ada")], "id_utilisateur int, login string")
    who = spark.createDataFrame([("ADA",), ("bob",)], "who string")
    assert rows(indicators.user_ids(who, users, "who")) == [("ADA", 7), ("bob", 0)]


def test_risk_level(spark):
    df = spark.createDataFrame([(0.0,), (0.29,), (0.3,), (0.69,), (0.7,), (1.0,)], "p double")
    got = [r[0] for r in df.select(indicators.risk_level(F.col("p"))).collect()]
    assert got == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_derived_merchants_and_errors(spark, rows):
    raw = spark.createDataFrame(
        [(5, 1, 10, "B", None, None), (3, 1, 10, "A", "CA", "1"), (4, 2, 11, "C", None, None)],
        "id_transaction bigint, id_marchand bigint, code_mcc int, merchant_city string, merchant_state string, zip string",
    )
    assert rows(derive.merchants(raw)) == [(1, 10, "A", "CA", "1"), (2, 11, "C", None, None)]
    errors = spark.createDataFrame(
        [(1, "Bad PIN, Technical Glitch"), (2, None), (3, " , Bad CVV,,"), (4, "")], "id_transaction bigint, errors string"
    )
    assert rows(derive.error_rows(errors)) == [(100, 1, "Bad PIN"), (101, 1, "Technical Glitch"), (301, 3, "Bad CVV")]


def test_unique_rows(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1)], "k int, x string, y int")
    assert rows(derive.unique_rows(df, "k")) == [(1, "a", 9), (2, None, 1)]
    assert rows(derive.repeated_keys(df, "k")) == [(1, 2)]


def test_rules_and_orphans(tiny, rows, spark):
    bad = spark.createDataFrame(
        [(1, 130, 1899, 13, "X", 299, -1), (2, 1, 1900, None, None, None, 0)],
        "id_client bigint, current_age int, birth_year int, birth_month int, gender string, credit_score int, num_credit_cards int",
    ).selectExpr("*", "cast(null as int) retirement_age", "cast(91 as decimal(8,5)) latitude", "cast(-181 as decimal(9,5)) longitude")
    found = {r.regle: r.violations for r in quality.check_rules(bad, "client").collect()}
    assert found["current_age 1..129"] == 1 and found["birth_year from 1900"] == 1
    assert found["gender known"] == 1 and found["credit_score 300..850"] == 1 and found["birth_month 1..12"] == 1
    assert found["num_credit_cards from 0"] == 1 and found["latitude -90..90"] == 2 and found["longitude -180..180"] == 2
    lost = quality.orphans(tiny["transaction"], "id_carte", tiny["carte"].where("id_carte <> 10"), "id_carte")
    assert rows(lost) == [(10, 3)]


def test_retention(spark, rows):
    df = spark.createDataFrame([(1, "2022-01-01"), (2, "2024-01-01")], "i int, d string").select("i", F.col("d").cast("timestamp").alias("_ingested_at"))
    assert rows(quality.retained(df, F.lit(datetime(2024, 1, 2))), "i") == [(2,)]


def test_request_contract(spark):
    schema = "amount double, use_chip string, mcc_code int, merchant_state string, hour int, current_age double, gender string"
    df = spark.createDataFrame(
        [
            (10.0, None, None, None, None, None, None), (0.0, "Chip Transaction", 1, "CA", 0, 1.0, "Male"),
            (float("nan"), None, None, None, None, None, None), (5.0, "Cash", -1, "x" * 11, 24, 120.0, "Other"),
        ],
        schema,
    )
    got = [r.erreurs for r in quality.validated(df).collect()]
    assert got == ["", "amount", "amount", "use_chip,mcc_code,merchant_state,hour,current_age,gender"]
    assert quality.valid_requests(df).count() == 1 and quality.quarantined(df).count() == 3


def test_audit_of_cards_never_logs_secrets(spark):
    schema = "id_carte bigint, id_client bigint, card_brand string, card_number_enc string, cvv_enc string, credit_limit decimal(12,2), card_on_dark_web string"
    before = spark.createDataFrame([(1, 1, "Visa", "PAN1", "CVV1", D("10.50"), "N"), (2, 1, "Visa", "PAN2", "CVV2", None, "N"), (3, 2, "Amex", "PAN3", "CVV3", D(1), "N")], schema)
    after = spark.createDataFrame([(1, 1, "Visa", "NEWPAN", "CVV1", D("10.50"), "N"), (2, 1, "Visa", "PAN2", "CVV2", None, "N"), (4, 9, "Visa", "PAN4", "CVV4", None, "Y")], schema)
    got = {r.id_ligne_concernee: r for r in audit.changes(before, after, audit.CARTE).collect()}
    assert {k: r.operation for k, r in got.items()} == {1: "UPDATE", 3: "DELETE", 4: "INSERT"}
    assert got[1].valeur_avant == '{"credit_limit":10.50,"card_on_dark_web":"N"}'
    assert got[4].valeur_apres == '{"id_carte":4,"id_client":9,"card_brand":"Visa","credit_limit":null}'
    assert got[4].valeur_avant is None and got[3].valeur_apres is None
    assert not any("PAN" in str(r) or "CVV" in str(r) for r in got.values())


def test_journal_and_merge(spark, rows):
    before = spark.createDataFrame([(1, 30, 700), (2, 40, None)], "id_client bigint, current_age int, credit_score int")
    after = spark.createDataFrame([(1, 30, 701), (2, 40, None), (3, 50, 800)], "id_client bigint, current_age int, credit_score int")
    at = F.lit(datetime(2024, 6, 1))
    journal = audit.stamped(audit.changes(before, after, audit.CLIENT), F.lit(7), at)
    assert rows(listing.count_by(journal, "table_concernee", "operation")) == [("CLIENT", "INSERT", 1), ("CLIENT", "UPDATE", 1)]
    assert audit.history_of(journal, "CLIENT", 1).first().valeur_apres == '{"current_age":30,"credit_score":701}'
    again = audit.stamped(audit.changes(before, after, audit.CLIENT), F.lit(7), at)
    assert rows(journal, "id_audit") == rows(again, "id_audit")
    got = rows(audit.merged(before, after, "id_client", at))
    assert got == [(1, 30, 701, datetime(2024, 6, 1)), (2, 40, None, None), (3, 50, 800, None)]


def test_hot_key_is_sliced_and_nothing_lost(spark, rows):
    """A third of all rows on one key: salted and plain join agree."""
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = spread_join(fact, dim, "k", ["id"], rows_per_slice=100, salted=True)
    plain = spread_join(fact, dim, "k", ["id"], salted=False)
    assert rows(salted, "id", "k", "v") == rows(plain, "id", "k", "v")
    assert salted.columns == plain.columns


def test_join_is_plain_only_with_runtime_split(spark, capsys):
    fact, dim = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        spread_join(fact, dim, "k", ["k"]).explain()
        assert "_slice" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spread_join(fact, dim, "k", ["k"]).explain()
    assert "_slice" not in capsys.readouterr().out


def test_broadcast_only_below_the_threshold(spark, tiny, docs, capsys):
    from cardloom.operators.skew import fits_broadcast

    small = spark.range(100)
    assert fits_broadcast(small) and not fits_broadcast(spark.range(10_000_000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not fits_broadcast(small)
        enrich.card_holder(tiny["carte"], tiny["client"]).explain()
        assert "SortMergeJoin" in capsys.readouterr().out
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1GB")
        assert fits_broadcast(spark.range(10_000_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_means_equal_decimal_arithmetic(spark):
    """Random totals against Python's decimal half-up."""
    import random
    from decimal import ROUND_HALF_UP

    from cardloom.functions.exact import half_up_mean

    rnd = random.Random(5)
    data = [(D(rnd.randint(-10**9, 10**9)) / 100, rnd.randint(1, 2000)) for _ in range(3000)]
    df = spark.createDataFrame([(str(t), n) for t, n in data], "t string, n bigint")
    got = [r[0] for r in df.select(half_up_mean(F.col("t").cast("decimal(22,2)"), F.col("n"))).collect()]
    want = [(t / n).quantize(D("0.01"), rounding=ROUND_HALF_UP) for t, n in data]
    assert [g + 0 for g in got] == [w + 0 for w in want]


def test_document_filters_reach_the_scan(spark, docs, tmp_path):
    path = str(tmp_path / "d")
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = stored.where(listing.transaction_filter(id_client=1, date_from=datetime(2024, 1, 1)))._jdf.queryExecution().toString()
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "client.id_client" in pushed and "date_transaction" in pushed
