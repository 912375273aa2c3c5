"""Cases in which wrong answers were once given."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cardloom.functions import clean
from cardloom.functions.crypto import key_from_env
from cardloom.learning import model
from cardloom.operators import indicators, listing, quality
from cardloom.plans import load
from cardloom.sources import raw
from cardloom.sources.binding import Binding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_line_is_a_transaction(spark, sf):
    m = Binding(spark, f"/root/testdata/{sf}")
    n = m.given("lineitem").count()
    got = m.transaction.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id_transaction").alias("ids")).first()
    assert (got.n, got.ids) == (n, n)


def test_filters_reach_the_scan(spark):
    from cardloom.suite.catalog import QUERIES

    for name in ("top_cards_of_month", "retained_documents"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
        if name == "top_cards_of_month":
            assert "l_shipdate" in plan.split("PushedFilters:")[1].split("]")[0] and "Window" not in plan


def test_repeated_logins_belong_to_nobody(spark):
    users = spark.createDataFrame([(7, "ada"), (8, "ADA"), (9, "bob")], "id_utilisateur int, login string")
    who = spark.createDataFrame([("Ada",), ("BOB",), ("eve",)], "who string")
    got = {r.who: r.id_utilisateur for r in indicators.user_ids(who, users, "who").collect()}
    assert got == {"Ada": 0, "BOB": 9, "eve": 0}


def test_suite_equals_the_single_reports(spark):
    """One read of each of nine tables with planted faults gives what the reports of rules, orphans and repeats give."""
    from cardloom.suite.base import Model
    from cardloom.suite.maintained import _faulty_tables

    tables = _faulty_tables(Model(spark, SF))
    tables["utilisateur_si"] = tables["utilisateur_si"].unionByName(tables["utilisateur_si"].limit(3))
    tables["label_fraude"] = tables["label_fraude"].unionByName(tables["label_fraude"].where("id_transaction % 5 = 0"))
    want = {("regle", name, r.regle): r.violations for name, df in tables.items() for r in quality.check_rules(df, name).collect()}
    want |= {("orphelin", r.nom_table, r.cle): r.orphelins for r in quality.orphan_report(tables).collect()}
    want |= {("doublon", r.nom_table, r.cle): r.doublons for r in quality.uniqueness_report(tables).collect()}
    found = quality.suite(tables).collect()
    assert {(r.famille, r.nom_table, r.regle): r.violations for r in found} == want and len(found) == len(want)
    assert sum(n > 0 for (family, *_), n in want.items() if family == "orphelin") > 2
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r.violations for r in quality.suite(empty).collect()} == {0}


def test_suite_with_journal_and_without_keys(spark):
    journal = spark.createDataFrame(
        [(1, 5, "client", 3, "UPDATE"), (1, 6, "client", 3, None)],
        "id_audit bigint, id_utilisateur int, table_concernee string, id_ligne_concernee bigint, operation string",
    )
    got = {(r.famille, r.regle): r.violations for r in quality.suite({"journal_audit": journal}).collect()}
    assert got["doublon", "id_audit"] == 1 and got["regle", "operation not null"] == 1
    users = spark.createDataFrame([(5, "a", "A", "x@y", None, "Y"), (6, "a", "B", "x@z", "etl", None)], "id_utilisateur int, login string, nom_complet string, email string, role string, actif string")
    both = {(r.famille, r.nom_table, r.regle): r.violations for r in quality.suite({"journal_audit": journal, "utilisateur_si": users}).collect()}
    assert both["orphelin", "journal_audit", "id_utilisateur"] == 0
    assert both["doublon", "utilisateur_si", "login"] == 1 and both["doublon", "utilisateur_si", "email"] == 0
    assert both["regle", "utilisateur_si", "role not null"] == both["regle", "utilisateur_si", "actif not null"] == 1
    assert quality.orphan_report({"mcc": spark.createDataFrame([(1, "x")], "code_mcc int, libelle_mcc string")}).count() == 0


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("id,name\n1,x\n")
    assert raw.read_csv(spark, str(tmp_path / "d"), ["name", "id"]).first().name == "x"
    assert raw.read_csv(spark, str(tmp_path / "d"), ["name"], keep_corrupt=True).first()[1] is None
    (tmp_path / "d" / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="CSV header"):
        raw.read_csv(spark, str(tmp_path / "d"), ["name", "id"]).collect()


def test_last_of_repeated_labels_holds(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text('{"target": {"1": "Yes", "2": "No", "1": "No", "3": "Yes", "2": "Yes"}}')
    assert {r.id_transaction: r.is_fraud for r in raw.fraud_labels(spark, str(path)).collect()} == {1: "N", 2: "Y", 3: "Y"}


def test_second_load_is_refused(spark, tmp_path, monkeypatch):
    (tmp_path / "mcc_codes.json").write_text('{"1": "a"}')
    monkeypatch.setenv("ENCRYPTION_KEY", "AAECAwQFBgcICQoLDA0ODxAREhMUFRYXGBkaGxwdHh8=")
    job = load.Load(spark, str(tmp_path), str(tmp_path / "tables"), key_from_env())
    load.run(job, ["mcc"])
    with pytest.raises(ValueError, match="has rows already"):
        load.run(job, ["mcc"])
    assert spark.read.parquet(str(tmp_path / "tables" / "mcc")).count() == 1


def test_missing_words(spark):
    df = spark.createDataFrame([("#N/A",), ("n/a",), (" <NA> ",), ("-nan",), ("nano",)], "t string")
    assert [r.t for r in df.select(clean.text(F.col("t")).alias("t")).collect()] == [None, None, None, None, "nano"]


def test_values_outside_the_contract_are_counted_together(spark, docs):
    odd = docs.withColumn("use_chip", F.concat(F.lit("kind "), F.col("id_transaction").cast("string")))
    odd = odd.withColumn("fraude", F.struct(F.lit(True).alias("is_fraud"), F.lit(True).alias("labelled")))
    assert listing.fraud_stats(odd).first().par_type_paiement == {"Hors contrat": 5}


def test_areas_are_exact(spark):
    n = 5000
    rows = [(int((i * 7919) % 10 < 3), float(i % 2), float((i * 31) % 4999)) for i in range(n)]
    got = model.evaluate_scores(spark.createDataFrame(rows, "label int, prediction double, rawPrediction double"))
    pos = sorted(s for y, _, s in rows if y)
    from bisect import bisect_left, bisect_right

    wins = sum(len(pos) - (bisect_left(pos, s) + bisect_right(pos, s)) / 2 for y, _, s in rows if not y)
    assert got["roc_auc"] == pytest.approx(wins / (len(pos) * (n - len(pos))), abs=1e-12)


def test_same_forest_for_any_layout(spark):
    rows = spark.range(600).selectExpr(
        "id AS id_transaction", "double(id % 97) AS amount", "'Swipe Transaction' AS use_chip", "int(id % 7) AS mcc_code",
        "'CA' AS merchant_state", "int(id % 24) AS hour", "double(20 + id % 50) AS current_age", "'Male' AS gender", "int(id % 97 > 80) AS label",
    )
    one, other = (model.fit(rows.repartition(n), model.forest(5, 4)).stages[-1].toDebugString for n in (3, 11))
    # sums of floats may differ in the last digit
    plain = lambda text: re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda x: f"{float(x[0]):.9f}", text).split("\n")[1:]
    assert plain(one) == plain(other)
