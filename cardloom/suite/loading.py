"""Raw scans, sinks, encryption, lake layers."""

from __future__ import annotations

import base64
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.functions import crypto
from cardloom.operators import datamarts, derive, enrich, listing
from cardloom.operators.skew import planned_bytes
from cardloom.plans import lake, marts, surface
from cardloom.sources import raw, tables
from cardloom.suite import landing
from cardloom.suite.base import FRAUDS_SQL, Model, day_sql, mean_sql, money_sql, query, rate_sql, time_sql

# A fixed key for the round trips below, never one that guards data.
SAMPLE_KEY = base64.b64encode(bytes(range(32))).decode()

# Source bytes per bucket of a stored table.
BUCKET_BYTES = 16 << 20

# ---------------------------------------------------------------- raw scans


@query("load_clients", """
SELECT id_client, current_age, retirement_age, birth_year, birth_month, gender, address,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       CAST(credit_score AS DOUBLE) AS credit_score, num_credit_cards
FROM client""")
def load_clients(m: Model):
    rows = raw.clean_users(raw.users(m.spark, landing.users(m)))
    return rows.drop("per_capita_income", "yearly_income", "total_debt").withColumn(
        "credit_score", F.col("credit_score").cast("double")
    )


@query("load_cards", f"""
SELECT id_carte, id_client, card_brand, card_type, expires, has_chip, num_cards_issued,
       {money_sql('limit_cents')} AS credit_limit, year_pin_last_changed, card_on_dark_web,
       {day_sql("CASE WHEN id_carte % 2 = 0 THEN date_trunc('month', acct_open_date) ELSE acct_open_date END")} AS acct_open_date
FROM carte""")
def load_cards(m: Model):
    return raw.clean_cards(raw.cards(m.spark, landing.cards(m))).drop("card_number_enc", "cvv_enc")


_LOADED_TX = f"""id_transaction, id_carte, id_marchand, {time_sql('date_transaction')} AS date_transaction,
       {money_sql('CASE WHEN id_transaction % 11 = 0 THEN -cents ELSE cents END')} AS amount, use_chip,
       {day_sql('situation_date')} AS situation_date"""


@query("load_transactions", f"SELECT {_LOADED_TX} FROM tx")
def load_transactions(m: Model):
    return raw.clean_transactions(raw.transactions(m.spark, landing.transactions(m)), raw.transaction_day())


@query("load_mcc", "SELECT code_mcc, libelle_mcc FROM mcc")
def load_mcc(m: Model):
    return raw.mcc_codes(m.spark, landing.mcc_codes(m))


@query("load_labels", "SELECT id_transaction, is_fraud FROM label")
def load_labels(m: Model):
    return raw.fraud_labels(m.spark, landing.labels(m))


@query("load_errors", """
SELECT id_transaction * 100 AS id_erreur, id_transaction, 'Bad PIN' AS code_erreur FROM ln WHERE l_discount >= 0.09
UNION ALL SELECT id_transaction * 100 + CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END, id_transaction,
       'Insufficient Balance' FROM ln WHERE l_tax >= 0.07""")
def load_errors(m: Model):
    rows = raw.transactions(m.spark, landing.transactions(m), ["id", "errors"])
    return derive.error_rows(raw.error_fields(rows))


@query("load_merchants", """
SELECT id_marchand, CAST(id_marchand % 25 AS INTEGER) AS code_mcc, 'Ville ' || CAST(first % 10 AS VARCHAR) AS merchant_city,
       CASE WHEN first % 29 <> 0 THEN 'S' || CAST(id_marchand % 61 AS VARCHAR) END AS merchant_state,
       CASE WHEN first % 29 <> 0 THEN lpad(CAST(id_marchand AS VARCHAR), 9, '0') END AS zip
FROM (SELECT id_marchand, min(id_transaction) AS first FROM tx GROUP BY id_marchand)""")
def load_merchants(m: Model):
    columns = ["id", "merchant_id", "mcc", "merchant_city", "merchant_state", "zip"]
    return derive.merchants(raw.merchant_fields(raw.transactions(m.spark, landing.transactions(m), columns)))


# -------------------------------------------------------------------- sinks


def _monthly(m: Model):
    path = landing.once(m, "monthly", lambda p: tables.write_monthly(m.transaction, p))
    return path


@query("append_batches", "SELECT year(situation_date) % 2 AS lot, count(*) AS nb FROM tx GROUP BY 1")
def append_batches(m: Model):
    """Two appends into one table, read back."""

    def write(path: str) -> None:
        for lot in (0, 1):
            tables.append(m.transaction.where(F.year("situation_date") % 2 == lot), path)

    rows = m.spark.read.parquet(landing.once(m, "appended", write))
    return listing.count_by(rows.select((F.year("situation_date") % 2).cast("bigint").alias("lot")), "lot")


@query("month_partitions", """
SELECT p AS partition_name, CAST(row_number() OVER (ORDER BY p) AS INTEGER) AS partition_position
FROM (SELECT DISTINCT strftime(situation_date, '%Y%m') AS p FROM tx)""")
def month_partitions(m: Model):
    return tables.months(m.spark, _monthly(m))


@query("month_range", f"""
SELECT id_transaction, id_carte, {money_sql('cents')} AS amount, {day_sql('situation_date')} AS situation_date
FROM tx WHERE situation_date BETWEEN DATE '1998-02-10' AND DATE '1998-04-05'""")
def month_range(m: Model):
    rows = tables.in_months(m.spark.read.parquet(_monthly(m)), date(1998, 2, 10), date(1998, 4, 5))
    return rows.select("id_transaction", "id_carte", "amount", "situation_date")


@query("stored_documents", f"""
SELECT id_transaction, id_carte, id_client, code_mcc, {money_sql('cents')} AS amount, is_fraud FROM flat""")
def stored_documents(m: Model):
    path = landing.once(m, "documents", lambda p: tables.write_documents(m.docs, p, drop_existing=True))
    return enrich.flatten(tables.read_documents(m.spark, path)).select(
        "id_transaction", "id_carte", "id_client", "code_mcc", "amount", "is_fraud"
    )


@query("client_sorted_documents", f"""
SELECT id_transaction, {time_sql('date_transaction')} AS date_transaction FROM flat WHERE id_client = 8
ORDER BY flat.date_transaction DESC, id_transaction LIMIT 5""")
def client_sorted_documents(m: Model):
    docs = landing.documents(m)
    return listing.page(docs, listing.transaction_filter(id_client=8), 1, 5).select("id_transaction", "date_transaction")


@query("find_stored_transaction", f"""
SELECT id_transaction, id_carte, id_client, code_mcc, {money_sql('cents')} AS amount FROM flat WHERE id_transaction = 13000""")
def find_stored_transaction(m: Model):
    """Point lookup in documents clustered by id: one file's row group is read."""
    found = listing.find_transaction(landing.documents(m, by_id=True), 13000)
    return enrich.flatten(found).select("id_transaction", "id_carte", "id_client", "code_mcc", "amount")


@query("bucketed_card_datamart", f"""
SELECT id_carte, nb_transactions, {money_sql('total')} AS total_amount,
       {mean_sql('total', 'nb_transactions')} AS avg_amount, nb_fraudes, CAST(rate AS DOUBLE) / 10000 AS taux_fraude_pct
FROM rates""")
def bucketed_card_datamart(m: Model):
    """Card datamart from stored tables bucketed by transaction: the label join needs no shuffle."""
    buckets = max(4, -(-planned_bytes(m.given("lineitem")) // BUCKET_BYTES))

    def write(path: str) -> None:
        for part, df in (("tx", m.transaction), ("label", m.label_fraude)):
            table = f"cardloom_{part}_{path.rsplit('-', 1)[1]}"
            tables.write_bucketed(df, table, f"{path}/{part}", "id_transaction", buckets)

    suffix = landing.once(m, "bucketed", write).rsplit("-", 1)[1]
    return datamarts.card_datamart(m.spark.table(f"cardloom_tx_{suffix}"), m.spark.table(f"cardloom_label_{suffix}"))


@query("refreshed_datamarts", f"""
SELECT 'card' AS nom_table, count(*) AS nb_lignes, CAST(sum(nb_transactions) AS BIGINT) AS nb_tx, {money_sql('sum(total)')} AS total FROM mart
UNION ALL SELECT 'daily', count(DISTINCT situation_date), count(*), {money_sql('sum(cents)')} FROM tl
UNION ALL SELECT 'category', count(DISTINCT code_mcc), count(*), {money_sql('sum(cents)')}
FROM tx JOIN marchand USING (id_marchand) JOIN mcc USING (code_mcc)""")
def refreshed_datamarts(m: Model):
    """Rows, transactions and amounts of the three stored datamarts."""
    counts = {"card": "nb_transactions", "daily": "nb_tx", "category": "nb_transactions"}
    return reduce(DataFrame.unionByName, [
        landing.datamart(m, name).agg(
            F.count(F.lit(1)).alias("nb_lignes"), F.sum(counts[name]).alias("nb_tx"), F.sum("total_amount").cast("double").alias("total")
        ).select(F.lit(name).alias("nom_table"), "nb_lignes", "nb_tx", "total")
        for name in marts.ORDER
    ])


@query("stored_risky_cards", """
SELECT id_carte, nb_transactions, nb_fraudes, CAST(rate AS DOUBLE) / 10000 AS taux_fraude_pct
FROM rates WHERE nb_transactions >= 5 ORDER BY rate DESC, id_carte LIMIT 10""")
def stored_risky_cards(m: Model):
    mart = marts.read(m.spark, landing.gold(m), "card")
    top = listing.ranked_cards(mart, "taux_fraude_pct", limit=10, min_transactions=5)
    return top.select("id_carte", "nb_transactions", "nb_fraudes", "taux_fraude_pct")


def _incremental(m: Model) -> str:
    """Gold state built from two batches, cut at the year 1998."""

    def write(gold: str) -> None:
        for batch, part in (("0001", F.year("situation_date") < 1998), ("0002", F.year("situation_date") >= 1998)):
            t = {"transaction": m.labelled_transaction.where(part), "marchand": m.marchand, "mcc": m.mcc}
            marts.apply_batch(m.spark, t, gold, batch)

    return landing.once(m, "incremental", write)


@query("incremental_card_datamart", f"""
SELECT id_carte, nb_transactions, {money_sql('total')} AS total_amount,
       {mean_sql('total', 'nb_transactions')} AS avg_amount, nb_fraudes, CAST(rate AS DOUBLE) / 10000 AS taux_fraude_pct
FROM rates""")
def incremental_card_datamart(m: Model):
    return marts.read(m.spark, _incremental(m), "card")


@query("incremental_category_datamart", f"""
SELECT code_mcc, libelle_mcc, count(*) AS nb_transactions, {money_sql('sum(cents)')} AS total_amount,
       {mean_sql('sum(cents)', 'count(*)')} AS avg_amount, count(DISTINCT id_carte) AS nb_cartes_uniques
FROM tx JOIN marchand USING (id_marchand) JOIN mcc USING (code_mcc) GROUP BY code_mcc, libelle_mcc""")
def incremental_category_datamart(m: Model):
    return marts.read(m.spark, _incremental(m), "category")


@query("refreshed_days", f"""
SELECT {day_sql('situation_date')} AS situation_date, count(*) AS nb_tx, {money_sql('sum(cents)')} AS total_amount,
       {FRAUDS_SQL} AS nb_fraudes, {rate_sql(FRAUDS_SQL, 'count(*)')} AS taux_fraude_pct
FROM tl WHERE situation_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31' GROUP BY situation_date""")
def refreshed_days(m: Model):
    """Two overlapping day ranges; the second replaces what they share."""

    def write(gold: str) -> None:
        t = {"transaction": m.spark.read.parquet(_monthly(m)), "label_fraude": m.label_fraude}
        marts.refresh_days(t, gold, date(1998, 1, 1), date(1998, 2, 28))
        marts.refresh_days(t, gold, date(1998, 2, 1), date(1998, 3, 31))

    rows = m.spark.read.parquet(f"{landing.once(m, 'days', write)}/daily_by_day")
    return rows.select("situation_date", "nb_tx", "total_amount", "nb_fraudes", "taux_fraude_pct")


# --------------------------------------------------------------- encryption


@query("encryption_round_trip", """
SELECT id_client, address, 4 * ((28 + length(address) + 2) // 3) AS longueur FROM client""")
def encryption_round_trip(m: Model):
    """Address encrypted, written, read and decrypted; with the length of the cipher text."""
    clear = m.client.select("id_client", "address")
    stored = landing.parquet(m, "encrypted", crypto.encrypt_columns(clear, ["address"], SAMPLE_KEY))
    rows = stored.withColumn("longueur", F.length("address").cast("bigint"))
    return crypto.decrypt_columns(rows, ["address"], SAMPLE_KEY)


@query("pseudonymised_clients", """
SELECT sha256(CAST(id_client AS VARCHAR) || 'sel') AS id_client, current_age FROM client""")
def pseudonymised_clients(m: Model):
    return lake.pseudonymised(m.client.select("id_client", "current_age"), F.lit("sel"))


# -------------------------------------------------------------- SQL surface


def sql_tables(m: Model) -> None:
    t = {
        "transaction": m.transaction, "label_fraude": m.label_fraude, "carte": m.carte, "client": m.client,
        "marchand": m.marchand, "mcc": m.mcc, "utilisateur_si": m.utilisateur_si,
    }
    surface.register(m.spark, t)


@query("sql_functions", """
SELECT c.id_carte, coalesce(CAST(r.rate AS DOUBLE) / 10000, 0) AS taux,
       CASE WHEN coalesce(r.rate, 0) >= 50000 THEN 'Y' ELSE 'N' END AS a_risque,
       CASE WHEN c.id_carte % 40 < 25 THEN (SELECT libelle_mcc FROM mcc WHERE code_mcc = c.id_carte % 40)
            ELSE 'MCC inconnu (' || CAST(c.id_carte % 40 AS VARCHAR) || ')' END AS categorie
FROM carte c LEFT JOIN rates r USING (id_carte)""")
def sql_functions(m: Model):
    """The SQL functions called for every card; Spark turns each call into a join."""
    sql_tables(m)
    return m.spark.sql(
        "SELECT id_carte, fn_calc_taux_fraude_carte(id_carte) AS taux, fn_carte_a_risque(id_carte) AS a_risque, "
        "fn_get_libelle_mcc(CAST(id_carte % 40 AS INT)) AS categorie FROM carte"
    )


@query("sql_client_functions", """
SELECT 'transactions' AS fonction, CAST(id_transaction AS VARCHAR) AS cle, CAST(cents AS DOUBLE) / 100 AS valeur FROM flat WHERE id_client = 8
UNION ALL SELECT 'user', login, CAST(id_utilisateur AS DOUBLE) FROM utilisateur
UNION ALL SELECT 'user', 'nobody', 0
UNION ALL SELECT 'risque', CAST(id_client AS VARCHAR), greatest(0, least(100, CAST((scaled + 50 * n) // (100 * n) AS DOUBLE) / 100))
FROM (SELECT cl.id_client, greatest(count(c.id_carte), 1) AS n,
             5 * coalesce(sum(coalesce(r.rate, 0)), 0)
             + (100000 * sum(CASE WHEN c.card_on_dark_web = 'Y' THEN 1 ELSE 0 END)
                + 1000 * (850 - coalesce(any_value(cl.credit_score), 850))) * greatest(count(c.id_carte), 1) AS scaled
      FROM client cl LEFT JOIN carte c USING (id_client) LEFT JOIN rates r ON c.id_carte = r.id_carte
      GROUP BY cl.id_client)""")
def sql_client_functions(m: Model):
    """Client risk for every client, user id for every login, the transactions of one client."""
    sql_tables(m)
    return m.spark.sql(
        "SELECT 'transactions' AS fonction, CAST(id_transaction AS STRING) AS cle, CAST(amount AS DOUBLE) AS valeur FROM fn_transactions_client(8) "
        "UNION ALL SELECT 'user', login, CAST(fn_get_user_id(upper(login)) AS DOUBLE) FROM utilisateur_si "
        "UNION ALL SELECT 'user', 'nobody', CAST(fn_get_user_id('nobody') AS DOUBLE) "
        "UNION ALL SELECT 'risque', CAST(id_client AS STRING), CAST(fn_calc_score_risque_client(id_client) AS DOUBLE) FROM client"
    )


# --------------------------------------------------------------------- lake


def _bronze(m: Model) -> str:
    source = landing.faulty_transactions(m)
    return landing.once(
        m, "bronze", lambda p: lake.to_bronze(m.spark, source, p, F.trunc(raw.transaction_day(), "year").cast("date"))
    )


@query("bronze_report", """
SELECT lignes, rejets, round(100.0::DOUBLE * rejets / lignes, 4) AS taux_rejet_pct
FROM (SELECT CAST(count(*) + count(CASE WHEN id_transaction % 53 = 0 THEN 1 END) + count(CASE WHEN id_transaction % 59 = 0 THEN 1 END) AS BIGINT) AS lignes,
             CAST(count(CASE WHEN id_transaction % 59 = 0 THEN 1 END) AS BIGINT) AS rejets FROM tx)""")
def bronze_report(m: Model):
    """Lines with broken and repeated ones among them."""
    return lake.bronze_report(m.spark.read.parquet(_bronze(m)))


@query("silver_transactions", f"""
SELECT id_transaction, id_carte, id_marchand, {money_sql('CASE WHEN id_transaction % 11 = 0 THEN -cents ELSE cents END')} AS amount
FROM tx WHERE cents <= 5000000 AND id_carte IN (SELECT id_carte FROM carte) AND id_marchand IN (SELECT id_marchand FROM marchand)""")
def silver_transactions(m: Model):
    bronze = m.spark.read.parquet(_bronze(m))
    rows = lake.silver_transactions(bronze, m.carte, m.marchand, limit=50000)
    return rows.select("id_transaction", "id_carte", "id_marchand", "amount")


@query("erasure", """
SELECT 'client' AS nom_table, id_client AS cle FROM client WHERE current_age <> 30
UNION ALL SELECT 'carte', id_carte FROM carte JOIN client USING (id_client) WHERE current_age <> 30
UNION ALL SELECT 'transaction', id_transaction FROM tx JOIN carte USING (id_carte) JOIN client USING (id_client) WHERE current_age <> 30
UNION ALL SELECT 'label_fraude', id_transaction FROM label JOIN tx USING (id_transaction) JOIN carte USING (id_carte)
  JOIN client USING (id_client) WHERE current_age <> 30
UNION ALL SELECT 'journal_audit', id_client FROM client WHERE current_age <> 30
UNION ALL SELECT 'journal_audit', id_carte FROM carte JOIN client USING (id_client) WHERE current_age <> 30""")
def erasure(m: Model):
    """Keys of the rows that stay after the clients of one age are erased; the journal has a row for each client and card."""
    journal = m.client.select(F.lit("client").alias("table_concernee"), F.col("id_client").alias("id_ligne_concernee")).unionByName(
        m.carte.select(F.lit("carte").alias("table_concernee"), F.col("id_carte").alias("id_ligne_concernee"))
    )
    t = {"client": m.client, "carte": m.carte, "transaction": m.transaction, "label_fraude": m.label_fraude, "journal_audit": journal}
    keys = {"client": "id_client", "carte": "id_carte", "transaction": "id_transaction", "label_fraude": "id_transaction", "journal_audit": "id_ligne_concernee"}
    left = lake.erased(t, m.client.where(F.col("current_age") == 30))
    return reduce(DataFrame.unionByName, [left[n].select(F.lit(n).alias("nom_table"), F.col(k).cast("bigint").alias("cle")) for n, k in keys.items()])
