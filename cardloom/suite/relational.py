"""Datamarts, enrichment, listings, indicators, derivations, checks, audit."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from cardloom.functions.clean import moment
from cardloom.operators import audit, datamarts, derive, enrich, indicators, listing, quality
from cardloom.suite import landing
from cardloom.suite.base import (
    FRAUDS_SQL, Model, day_sql, mean_sql, money_sql, query, rate_sql, time_sql,
)

# ---------------------------------------------------------------- datamarts


@query("card_datamart", f"""
SELECT id_carte, nb_transactions, {money_sql('total')} AS total_amount,
       {mean_sql('total', 'nb_transactions')} AS avg_amount, nb_fraudes,
       {rate_sql('nb_fraudes', 'nb_transactions')} AS taux_fraude_pct
FROM mart""")
def card_datamart(m: Model):
    return datamarts.card_datamart(*m.facts)


@query("daily_datamart", f"""
SELECT {day_sql('situation_date')} AS situation_date, count(*) AS nb_tx,
       {money_sql('sum(cents)')} AS total_amount, {mean_sql('sum(cents)', 'count(*)')} AS avg_amount,
       {FRAUDS_SQL} AS nb_fraudes, {rate_sql(FRAUDS_SQL, 'count(*)')} AS taux_fraude_pct
FROM tl GROUP BY situation_date""")
def daily_datamart(m: Model):
    return datamarts.daily_datamart(*m.facts)


_CATEGORY_SQL = f"""
SELECT code_mcc, libelle_mcc, count(*) AS nb_transactions, {money_sql('sum(cents)')} AS total_amount,
       {mean_sql('sum(cents)', 'count(*)')} AS avg_amount, count(DISTINCT id_carte) AS nb_cartes_uniques
FROM tx JOIN marchand USING (id_marchand) JOIN mcc USING (code_mcc) GROUP BY code_mcc, libelle_mcc"""


@query("category_datamart", _CATEGORY_SQL)
def category_datamart(m: Model):
    return datamarts.category_datamart(m.transaction, m.marchand, m.mcc)


@query("category_datamart_salted", _CATEGORY_SQL)
def category_datamart_salted(m: Model):
    """Same result by the salted join, used when adaptive skew join is off."""
    by_card = datamarts.category_cards(m.transaction, m.marchand, salted=True)
    return datamarts.category_totals(by_card, m.mcc)


@query("client_cards", f"""
SELECT cl.id_client, cl.current_age, cl.gender, CAST(cl.credit_score AS DOUBLE) AS credit_score,
       count(c.id_carte) AS nb_cartes, {money_sql('sum(c.limit_cents)')} AS plafond_total,
       CAST(sum(CASE WHEN c.card_on_dark_web = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS nb_cartes_dark_web
FROM client cl LEFT JOIN carte c ON cl.id_client = c.id_client
GROUP BY cl.id_client, cl.current_age, cl.gender, cl.credit_score""")
def client_cards(m: Model):
    rows = datamarts.client_cards(m.client, m.carte)
    return rows.withColumn("credit_score", F.col("credit_score").cast("double"))


@query("merchant_volume", f"""
SELECT m.id_marchand, m.merchant_city, m.merchant_state, mcc.libelle_mcc,
       count(t.id_transaction) AS nb_transactions, {money_sql('sum(t.cents)')} AS montant_total,
       {mean_sql('sum(t.cents)', 'nullif(count(t.id_transaction), 0)')} AS montant_moyen
FROM marchand m JOIN mcc ON m.code_mcc = mcc.code_mcc LEFT JOIN tx t ON m.id_marchand = t.id_marchand
GROUP BY m.id_marchand, m.merchant_city, m.merchant_state, mcc.libelle_mcc""")
def merchant_volume(m: Model):
    return datamarts.merchant_volume(m.transaction, m.marchand, m.mcc)


@query("fraud_categories_top", f"""
SELECT libelle_mcc, count(*) AS nb_fraudes, {money_sql('sum(cents)')} AS montant_fraude
FROM tl JOIN marchand USING (id_marchand) JOIN mcc USING (code_mcc) WHERE is_fraud = 'Y'
GROUP BY libelle_mcc ORDER BY nb_fraudes DESC, libelle_mcc LIMIT 20""")
def fraud_categories_top(m: Model):
    rows = datamarts.fraud_categories(m.transaction, m.label_fraude, m.marchand, m.mcc)
    return rows.orderBy(F.desc("nb_fraudes"), "libelle_mcc").limit(20)


@query("top_cards_of_month", f"""
SELECT id_carte, count(*) AS nb_tx, {money_sql('sum(cents)')} AS total_amount FROM tx
WHERE situation_date BETWEEN DATE '1998-03-01' AND last_day(DATE '1998-03-15')
GROUP BY id_carte ORDER BY nb_tx DESC, id_carte LIMIT 10""")
def top_cards_of_month(m: Model):
    return datamarts.top_cards_of_month(m.transaction, F.lit(date(1998, 3, 15)))


@query("document_card_datamart", f"""
SELECT id_carte, count(*) AS nb_transactions, {money_sql('sum(cents)')} AS total_amount,
       {mean_sql('sum(cents)', 'count(*)')} AS avg_amount, {FRAUDS_SQL} AS nb_fraudes,
       {rate_sql(FRAUDS_SQL, 'count(*)')} AS taux_fraude_pct
FROM flat GROUP BY id_carte""")
def document_card_datamart(m: Model):
    return enrich.document_datamarts(m.docs)["card"]


@query("document_daily_datamart", f"""
SELECT {day_sql('situation_date')} AS situation_date, count(*) AS nb_tx, {money_sql('sum(cents)')} AS total_amount,
       {mean_sql('sum(cents)', 'count(*)')} AS avg_amount, {FRAUDS_SQL} AS nb_fraudes,
       {rate_sql(FRAUDS_SQL, 'count(*)')} AS taux_fraude_pct
FROM flat GROUP BY situation_date""")
def document_daily_datamart(m: Model):
    return enrich.document_datamarts(m.docs)["daily"]


@query("document_category_datamart", _CATEGORY_SQL)
def document_category_datamart(m: Model):
    return enrich.document_datamarts(m.docs)["category"]


# --------------------------------------------------------------- enrichment

_FLAT_SELECT = f"""
SELECT id_transaction, {time_sql('date_transaction')} AS date_transaction, {money_sql('cents')} AS amount, use_chip,
       {day_sql('situation_date')} AS situation_date, id_carte, card_brand, card_type, has_chip,
       {money_sql('limit_cents')} AS credit_limit, card_on_dark_web, id_client, current_age, gender,
       CAST(credit_score AS DOUBLE) AS credit_score, num_credit_cards, id_marchand, merchant_city,
       merchant_state, zip, code_mcc, libelle_mcc, is_fraud FROM flat"""


def _score_as_double(df):
    return df.withColumn("credit_score", F.col("credit_score").cast("double"))


@query("enriched_flat", _FLAT_SELECT)
def enriched_flat(m: Model):
    return _score_as_double(m.flat)


@query("enriched_first_rows", f"{_FLAT_SELECT} ORDER BY id_transaction LIMIT 1000")
def enriched_first_rows(m: Model):
    return _score_as_double(enrich.first_rows(m.flat, 1000))


@query("enriched_documents", f"""
SELECT id_transaction, {money_sql('cents')} AS amount, id_carte, has_chip = 'Y' AS puce,
       card_on_dark_web = 'Y' AS dark_web, id_client, current_age, merchant_city AS ville,
       merchant_state AS etat, code_mcc AS code, libelle_mcc AS libelle,
       CASE WHEN is_fraud IS NULL THEN 'null' WHEN is_fraud = 'Y' THEN 'true' ELSE 'false' END AS is_fraud,
       is_fraud IS NOT NULL AS labelled
FROM flat""")
def enriched_documents(m: Model):
    return m.docs.select(
        "id_transaction", "amount", "carte.id_carte", F.col("carte.has_chip").alias("puce"),
        F.col("carte.card_on_dark_web").alias("dark_web"), "client.id_client", "client.current_age",
        "marchand.ville", "marchand.etat", "mcc.code", "mcc.libelle",
        F.coalesce(F.col("fraude.is_fraud").cast("string"), F.lit("null")).alias("is_fraud"), "fraude.labelled",
    )


@query("labelled_transactions", f"SELECT id_transaction, id_carte, {money_sql('cents')} AS amount, is_fraud FROM tl")
def labelled_transactions(m: Model):
    return datamarts.labelled(*m.facts).select("id_transaction", "id_carte", "amount", "is_fraud")


@query("category_label", """
SELECT m.id_marchand, m.code_mcc * 2 AS code_mcc,
       coalesce(mcc.libelle_mcc, 'MCC inconnu (' || CAST(m.code_mcc * 2 AS VARCHAR) || ')') AS libelle_mcc
FROM marchand m LEFT JOIN mcc ON m.code_mcc * 2 = mcc.code_mcc""")
def category_label(m: Model):
    rows = m.marchand.select("id_marchand", (F.col("code_mcc") * 2).alias("code_mcc"))
    return indicators.category_label(rows, m.mcc)


@query("repeated_logins", """
WITH more AS (SELECT id_utilisateur, login FROM utilisateur
              UNION ALL SELECT id_utilisateur + 100000, upper(login) FROM utilisateur WHERE id_utilisateur % 4 = 0),
one AS (SELECT upper(login) AS l, max(id_utilisateur) AS id FROM more GROUP BY 1 HAVING count(*) = 1)
SELECT u.login, coalesce(one.id, 0) AS id_utilisateur FROM utilisateur u LEFT JOIN one ON upper(u.login) = one.l
""".replace("WITH more", ", more", 1))
def repeated_logins(m: Model):
    """Every fourth login belongs to two users and so to none."""
    u = m.utilisateur_si.select("id_utilisateur", "login")
    again = u.where(F.col("id_utilisateur") % 4 == 0).select((F.col("id_utilisateur") + 100000).cast("int").alias("id_utilisateur"), F.upper("login").alias("login"))
    return indicators.user_ids(u.select("login"), u.unionByName(again)).select("login", "id_utilisateur")


@query("user_ids", """
SELECT c.id_client, 'USER_' || CAST(c.id_client AS VARCHAR) AS login,
       coalesce(u.id_utilisateur, 0) AS id_utilisateur
FROM client c LEFT JOIN utilisateur u ON upper(u.login) = 'USER_' || CAST(c.id_client AS VARCHAR)""")
def user_ids(m: Model):
    rows = m.client.select(
        "id_client", F.concat(F.lit("USER_"), F.col("id_client").cast("string")).alias("login")
    )
    return indicators.user_ids(rows.withColumnRenamed("login", "who"), m.utilisateur_si, "who").select(
        "id_client", F.col("who").alias("login"), "id_utilisateur"
    )


# --------------------------------------------------------------- indicators


@query("card_rates", """
SELECT c.id_carte, c.id_client, coalesce(CAST(r.rate AS DOUBLE) / 10000, 0) AS taux_fraude_pct
FROM carte c LEFT JOIN rates r USING (id_carte)""")
def card_rates(m: Model):
    return indicators.card_rates(m.carte.select("id_carte", "id_client"), datamarts.card_datamart(*m.facts))


@query("client_risk", """
SELECT id_client, greatest(0, least(100, CAST((scaled + 50 * n) // (100 * n) AS DOUBLE) / 100)) AS score_risque
FROM (SELECT cl.id_client, greatest(count(c.id_carte), 1) AS n,
             5 * coalesce(sum(coalesce(r.rate, 0)), 0)
             + (100000 * sum(CASE WHEN c.card_on_dark_web = 'Y' THEN 1 ELSE 0 END)
                + 1000 * (850 - coalesce(any_value(cl.credit_score), 850))) * greatest(count(c.id_carte), 1) AS scaled
      FROM client cl LEFT JOIN carte c USING (id_client) LEFT JOIN rates r ON c.id_carte = r.id_carte
      GROUP BY cl.id_client)""")
def client_risk(m: Model):
    return indicators.client_risk(m.client, m.carte, datamarts.card_datamart(*m.facts))


@query("card_alerts", """
SELECT c.id_carte, coalesce(CAST(r.rate AS DOUBLE) / 10000, 0) AS taux_fraude_pct,
       CASE WHEN coalesce(r.rate, 0) >= 50000 THEN 'Y' ELSE 'N' END AS carte_a_risque
FROM carte c LEFT JOIN rates r USING (id_carte)""")
def card_alerts(m: Model):
    return indicators.card_alerts(m.carte.select("id_carte"), datamarts.card_datamart(*m.facts))


@query("risk_levels", """
SELECT niveau, count(*) AS nb FROM (
  SELECT CASE WHEN id_transaction % 101 < 30 THEN 'LOW' WHEN id_transaction % 101 < 70 THEN 'MEDIUM'
              ELSE 'HIGH' END AS niveau FROM tx) GROUP BY niveau""")
def risk_levels(m: Model):
    p = (F.col("id_transaction") % 101) / 100
    return listing.count_by(m.transaction.select(indicators.risk_level(p).alias("niveau")), "niveau")


# ------------------------------------------------------- filters and listings

_ITEM_SQL = f"""id_transaction, {time_sql('date_transaction')} AS date_transaction, {money_sql('cents')} AS amount,
       id_client, id_carte, code_mcc, coalesce(is_fraud, '?') AS is_fraud"""


def _items(docs):
    return docs.select(
        "id_transaction", "date_transaction", "amount", "client.id_client", "carte.id_carte",
        F.col("mcc.code").alias("code_mcc"),
        F.when(F.col("fraude.is_fraud"), "Y").when(~F.col("fraude.is_fraud"), "N").otherwise("?").alias("is_fraud"),
    )


@query("filtered_transactions", f"""
SELECT {_ITEM_SQL} FROM flat WHERE code_mcc = 7 AND is_fraud = 'N'
AND date_transaction >= TIMESTAMP '1996-01-01' AND date_transaction <= TIMESTAMP '1999-12-31'""")
def filtered_transactions(m: Model):
    condition = listing.transaction_filter(
        code_mcc=7, is_fraud=False, date_from=datetime(1996, 1, 1), date_to=datetime(1999, 12, 31)
    )
    return _items(landing.documents(m).where(condition))


@query("fraud_transactions", f"SELECT {_ITEM_SQL} FROM flat WHERE is_fraud = 'Y'")
def fraud_transactions(m: Model):
    return _items(landing.documents(m).where(listing.transaction_filter(is_fraud=True)))


@query("client_transactions", f"SELECT {_ITEM_SQL} FROM flat WHERE id_client = 8")
def client_transactions(m: Model):
    return _items(landing.documents(m).where(listing.transaction_filter(id_client=8)))


@query("card_transactions", f"SELECT {_ITEM_SQL} FROM flat WHERE id_carte = 1")
def card_transactions(m: Model):
    return _items(landing.documents(m).where(listing.transaction_filter(id_carte=1)))


@query("find_transaction", f"SELECT {_ITEM_SQL} FROM flat WHERE id_transaction = 13000")
def find_transaction(m: Model):
    return _items(listing.find_transaction(landing.documents(m, by_id=True), 13000))


@query("one_fraud", f"SELECT {_ITEM_SQL} FROM flat WHERE is_fraud = 'Y' ORDER BY id_transaction LIMIT 1")
def one_fraud(m: Model):
    return _items(listing.one_fraud(landing.documents(m, by_id=True)))


@query("transactions_page", f"""
SELECT {_ITEM_SQL} FROM flat WHERE date_transaction <= TIMESTAMP '2000-06-30'
ORDER BY flat.date_transaction DESC, id_transaction LIMIT 20 OFFSET 40""")
def transactions_page(m: Model):
    condition = listing.transaction_filter(date_to=datetime(2000, 6, 30))
    return _items(listing.page(landing.documents(m), condition, 3, 20))


@query("transactions_page_keyset", f"""
SELECT {_ITEM_SQL} FROM flat
WHERE date_transaction < TIMESTAMP '2000-01-15' OR (date_transaction = TIMESTAMP '2000-01-15' AND id_transaction > 5000000)
ORDER BY flat.date_transaction DESC, id_transaction LIMIT 50""")
def transactions_page_keyset(m: Model):
    return _items(listing.page_after(landing.documents(m), F.lit(True), datetime(2000, 1, 15), 5000000, 50))


@query("transactions_total", "SELECT count(*) AS total FROM flat WHERE date_transaction <= TIMESTAMP '2000-06-30'")
def transactions_total(m: Model):
    return listing.total(landing.documents(m), listing.transaction_filter(date_to=datetime(2000, 6, 30)))


@query("latest_per_client", f"""
SELECT id_client, id_transaction, {time_sql('date_transaction')} AS date_transaction, {money_sql('cents')} AS amount,
       CAST(rang AS INTEGER) AS rang
FROM (SELECT *, row_number() OVER (PARTITION BY id_client ORDER BY date_transaction DESC, id_transaction) AS rang
      FROM flat) WHERE rang <= 5""")
def latest_per_client(m: Model):
    return listing.latest_per_client(landing.documents(m))


_MART_SQL = f"""id_carte, nb_transactions, {money_sql('total')} AS total_amount,
       {mean_sql('total', 'nb_transactions')} AS avg_amount, nb_fraudes, CAST(rate AS DOUBLE) / 10000 AS taux_fraude_pct"""


@query("top_cards", f"SELECT {_MART_SQL} FROM rates ORDER BY nb_transactions DESC, id_carte LIMIT 10")
def top_cards(m: Model):
    return listing.ranked_cards(landing.datamart(m, "card"), "nb_transactions", limit=10)


@query("risky_cards", f"""
SELECT {_MART_SQL} FROM rates WHERE nb_transactions >= 5 ORDER BY rate DESC, id_carte LIMIT 10""")
def risky_cards(m: Model):
    return listing.ranked_cards(landing.datamart(m, "card"), "taux_fraude_pct", limit=10, min_transactions=5)


@query("cards_by_amount_ascending", f"""
SELECT {_MART_SQL} FROM rates WHERE nb_transactions >= 3 ORDER BY total, id_carte LIMIT 50""")
def cards_by_amount_ascending(m: Model):
    return listing.ranked_cards(
        landing.datamart(m, "card"), "total_amount", descending=False, limit=50, min_transactions=3
    )


@query("top_categories", f"SELECT * FROM ({_CATEGORY_SQL}) ORDER BY nb_transactions DESC, code_mcc LIMIT 10")
def top_categories(m: Model):
    return listing.top_categories(landing.datamart(m, "category"))


# ------------------------------------------------------ activity and statistics


@query("client_summary", f"""
SELECT c.id_client, count(f.id_transaction) AS nb_transactions,
       {money_sql('coalesce(sum(f.cents), 0)')} AS total_amount,
       CAST(sum(CASE WHEN f.is_fraud = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS nb_fraudes,
       count(DISTINCT f.id_carte) AS nb_cartes_utilisees
FROM client c LEFT JOIN flat f ON c.id_client = f.id_client GROUP BY c.id_client""")
def client_summary(m: Model):
    return listing.client_summary(landing.documents(m), m.client)


@query("fraud_stats", f"""
SELECT (SELECT count(*) FROM flat) AS total_transactions, (SELECT count(*) FROM fr) AS nb_fraudes,
       {rate_sql('(SELECT count(*) FROM fr)', '(SELECT count(*) FROM flat)')} AS taux_global_pct,
       (SELECT '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' FROM
         (SELECT coalesce(gender, 'Unknown') AS k, CAST(count(*) AS VARCHAR) AS n FROM fr GROUP BY 1)) AS par_genre,
       (SELECT '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' FROM
         (SELECT use_chip AS k, CAST(count(*) AS VARCHAR) AS n FROM fr GROUP BY 1)) AS par_type_paiement
FROM (SELECT 1)""".replace("FROM fr", "FROM (SELECT * FROM flat WHERE is_fraud = 'Y') AS fr"))
def fraud_stats(m: Model):
    return listing.fraud_stats(landing.documents(m))


_AGE_SQL = """CASE WHEN current_age IS NULL OR current_age < 0 OR current_age >= 130 THEN 'unknown'
  WHEN current_age < 25 THEN '0' WHEN current_age < 35 THEN '25' WHEN current_age < 45 THEN '35'
  WHEN current_age < 55 THEN '45' WHEN current_age < 65 THEN '55' ELSE '65' END"""


@query("fraud_facets", f"""
SELECT 'par_genre' AS facet, coalesce(gender, 'Unknown') AS cle, count(*) AS nb
FROM flat WHERE is_fraud = 'Y' GROUP BY 2
UNION ALL SELECT 'par_tranche_age', {_AGE_SQL}, count(*) FROM flat WHERE is_fraud = 'Y' GROUP BY 2
UNION ALL SELECT 'par_type_paiement', use_chip, count(*) FROM flat WHERE is_fraud = 'Y' GROUP BY 2""")
def fraud_facets(m: Model):
    return listing.fraud_facets(landing.documents(m))


@query("fraud_age_classes", f"SELECT {_AGE_SQL} AS tranche, count(*) AS nb FROM flat WHERE is_fraud = 'Y' GROUP BY 1")
def fraud_age_classes(m: Model):
    return listing.age_classes(landing.documents(m))


@query("collection_report", f"""
SELECT count(*) AS total, count_if(is_fraud = 'Y') AS fraudes,
       CAST((200000 * CAST(count_if(is_fraud = 'Y') AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 1000 AS pct,
       count(DISTINCT id_carte) AS cartes, count(DISTINCT id_client) AS clients,
       count(DISTINCT id_marchand) AS marchands
FROM flat""".replace("count_if(is_fraud = 'Y')", "CAST(count(CASE WHEN is_fraud = 'Y' THEN 1 END) AS BIGINT)"))
def collection_report(m: Model):
    return listing.collection_report(landing.documents(m))


@query("class_distribution", f"""
SELECT is_fraud, count(*) AS nb, {rate_sql('count(*)', '(SELECT count(*) FROM label)')} AS pct
FROM label GROUP BY is_fraud""")
def class_distribution(m: Model):
    return listing.class_shares(m.label_fraude)


_ERRORS_SQL = """(
SELECT id_transaction * 100 AS id_erreur, id_transaction, 'Bad PIN' AS code_erreur FROM ln WHERE l_discount >= 0.09
UNION ALL SELECT id_transaction * 100 + CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END, id_transaction,
       'Insufficient Balance' FROM ln WHERE l_tax >= 0.07)"""


@query("datamart_counts", f"""
SELECT 'card' AS nom_table, count(*) AS nb_lignes FROM mart
UNION ALL SELECT 'daily', count(DISTINCT situation_date) FROM tl
UNION ALL SELECT 'category', count(*) FROM ({_CATEGORY_SQL}) c""")
def datamart_counts(m: Model):
    return listing.table_counts({name: landing.datamart(m, name) for name in ("card", "daily", "category")})


# ---------------------------------------------------- derivations and quality


@query("error_codes", f"SELECT id_erreur, id_transaction, code_erreur FROM {_ERRORS_SQL} e")
def error_codes(m: Model):
    return derive.error_rows(m.error_texts)


@query("repeated_lines", """
SELECT l_orderkey, l_linenumber, count(*) AS nb FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def repeated_lines(m: Model):
    return derive.repeated_keys(m.given("lineitem"), "l_orderkey", "l_linenumber")


@query("unique_transactions", f"""
SELECT id_transaction, id_carte, id_marchand, {money_sql('cents')} AS amount, use_chip FROM tx""")
def unique_transactions(m: Model):
    """One row per id, from a table in which every seventh id comes twice."""
    again = m.transaction.where(F.col("id_transaction") % 7 == 0)
    rows = derive.unique_rows(m.transaction.unionByName(again), "id_transaction")
    return rows.select("id_transaction", "id_carte", "id_marchand", "amount", "use_chip")


def _core_tables(m: Model):
    return {
        "mcc": m.mcc, "client": m.client, "marchand": m.marchand, "carte": m.carte,
        "transaction": m.transaction, "label_fraude": m.label_fraude,
        "erreur_transaction": derive.error_rows(m.error_texts),
    }


@query("orphan_report", f"""
SELECT 'carte' AS nom_table, 'id_client' AS cle,
       (SELECT count(*) FROM carte WHERE id_client NOT IN (SELECT id_client FROM client)) AS orphelins
UNION ALL SELECT 'marchand', 'code_mcc',
       (SELECT count(*) FROM marchand WHERE code_mcc NOT IN (SELECT code_mcc FROM mcc))
UNION ALL SELECT 'transaction', 'id_carte',
       (SELECT count(*) FROM tx WHERE id_carte NOT IN (SELECT id_carte FROM carte))
UNION ALL SELECT 'transaction', 'id_marchand',
       (SELECT count(*) FROM tx WHERE id_marchand NOT IN (SELECT id_marchand FROM marchand))
UNION ALL SELECT 'label_fraude', 'id_transaction',
       (SELECT count(*) FROM label WHERE id_transaction NOT IN (SELECT id_transaction FROM tx))
UNION ALL SELECT 'erreur_transaction', 'id_transaction',
       (SELECT count(*) FROM {_ERRORS_SQL} e WHERE id_transaction NOT IN (SELECT id_transaction FROM tx))""")
def orphan_report(m: Model):
    return quality.orphan_report(_core_tables(m))


@query("idle_cards", "SELECT id_carte, 1 AS nb FROM carte WHERE id_carte NOT IN (SELECT id_carte FROM tx)".replace("1 AS nb", "CAST(1 AS BIGINT) AS nb"))
def idle_cards(m: Model):
    """Anti join with a result: cards without any transaction."""
    return quality.orphans(m.carte, "id_carte", m.transaction, "id_carte")


@query("table_rules", """
SELECT * FROM (VALUES ('retirement_age 1..129'), ('num_credit_cards not null'), ('id_client not null'),
  ('current_age not null'), ('birth_year not null'),
  ('current_age 1..129'), ('birth_year from 1900'), ('birth_month 1..12'), ('gender known'), ('latitude -90..90'),
  ('longitude -180..180'), ('num_credit_cards from 0')) r(regle), (SELECT CAST(0 AS BIGINT) AS violations, count(*) AS lignes FROM client) n
UNION ALL SELECT 'credit_score 300..850', CAST(count(CASE WHEN credit_score + 100 > 850 THEN 1 END) AS BIGINT), count(*) FROM client""")
def table_rules(m: Model):
    """Client rules on scores raised by 100, so that some break the bound."""
    raised = m.client.withColumn("credit_score", F.col("credit_score") + 100)
    return quality.check_rules(raised, "client").drop("nom_table")


@query("quality_suite", """
SELECT 'regle' AS famille, 'label_fraude' AS nom_table, 'is_fraud Y/N' AS regle, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'regle', 'label_fraude', 'id_transaction not null', 0
UNION ALL SELECT 'regle', 'label_fraude', 'is_fraud not null', 0
UNION ALL SELECT 'regle', 'mcc', 'code_mcc not null', 0 UNION ALL SELECT 'regle', 'mcc', 'libelle_mcc not null', 0
UNION ALL SELECT 'regle', 'mcc', 'code 0..9999', 0
UNION ALL SELECT 'regle', 'marchand', 'id_marchand not null', 0 UNION ALL SELECT 'regle', 'marchand', 'code_mcc not null', 0
UNION ALL SELECT 'regle', 'transaction', r, (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL)
  FROM (VALUES ('id_transaction not null'), ('id_carte not null'), ('id_marchand not null'),
  ('date_transaction not null'), ('amount not null'), ('situation_date not null'), ('use_chip known')) v(r)
UNION ALL SELECT 'orphelin', 'marchand', 'code_mcc', (SELECT count(*) FROM marchand WHERE code_mcc NOT IN (SELECT code_mcc FROM mcc))
UNION ALL SELECT 'orphelin', 'transaction', 'id_marchand', (SELECT count(*) FROM tx WHERE id_marchand NOT IN (SELECT id_marchand FROM marchand))
UNION ALL SELECT 'orphelin', 'label_fraude', 'id_transaction', (SELECT count(*) FROM label WHERE id_transaction NOT IN (SELECT id_transaction FROM tx))
UNION ALL SELECT 'doublon', 'mcc', 'code_mcc', (SELECT count(*) - count(DISTINCT code_mcc) FROM mcc)
UNION ALL SELECT 'doublon', 'marchand', 'id_marchand', (SELECT count(*) - count(DISTINCT id_marchand) FROM marchand)
UNION ALL SELECT 'doublon', 'transaction', 'id_transaction', (SELECT count(*) FROM tx WHERE id_transaction % 50 = 0)
UNION ALL SELECT 'doublon', 'label_fraude', 'id_transaction', (SELECT count(*) - count(DISTINCT id_transaction) FROM label)""")
def quality_suite(m: Model):
    """Whole report, over a transaction table in which every 50th id comes twice and no payment type is known."""
    again = m.transaction.where(F.col("id_transaction") % 50 == 0)
    raw = m.transaction.unionByName(again).withColumn("use_chip", F.lit(None).cast("string"))
    return quality.suite(
        {"mcc": m.mcc, "marchand": m.marchand, "transaction": raw, "label_fraude": m.label_fraude}
    )


@query("retained_documents", f"""
SELECT id_transaction, {time_sql('date_transaction')} AS ingere FROM tx
WHERE date_transaction >= TIMESTAMP '2001-12-31' - INTERVAL 730 DAY""")
def retained_documents(m: Model):
    rows = m.transaction.select("id_transaction", F.col("date_transaction").alias("ingere"))
    return quality.retained(rows, moment(datetime(2001, 12, 31)), "ingere")


_REQUEST_SQL = """(
SELECT id_transaction, CASE WHEN id_transaction % 11 = 0 THEN -1 ELSE 1 END * cents AS cents,
  CASE id_transaction % 4 WHEN 0 THEN 'Swipe Transaction' WHEN 1 THEN 'Online Transaction' WHEN 2 THEN 'Chip Transaction' END AS use_chip,
  CASE WHEN id_transaction % 5 <> 0 THEN k + 5000 END AS mcc_code,
  CASE WHEN id_transaction % 3 = 0 THEN 'CA' WHEN id_transaction % 13 = 1 THEN 'OUT OF STATE' END AS merchant_state,
  CASE WHEN id_transaction % 7 <> 0 THEN hour(date_transaction) + CASE WHEN id_transaction % 19 = 0 THEN 24 ELSE 0 END END AS hour,
  CASE WHEN id_transaction % 6 <> 0 THEN k + 1 END AS current_age,
  CASE WHEN id_transaction % 5 = 0 THEN 'Other' WHEN id_transaction % 2 = 0 THEN 'Female' END AS gender,
  is_fraud
FROM ev)"""
_VALID_SQL = """cents > 0 AND (merchant_state IS NULL OR length(merchant_state) <= 10) AND (hour IS NULL OR hour BETWEEN 0 AND 23)
  AND (gender IS NULL OR gender IN ('Male', 'Female')) AND (current_age IS NULL OR (current_age > 0 AND current_age < 120))"""


@query("valid_requests", f"SELECT id_transaction, {money_sql('cents')} AS amount FROM {_REQUEST_SQL} r WHERE {_VALID_SQL}")
def valid_requests(m: Model):
    return quality.valid_requests(m.requests).select("id_transaction", "amount")


@query("quarantined_requests", f"""
SELECT id_transaction, concat_ws(',', CASE WHEN NOT cents > 0 THEN 'amount' END,
  CASE WHEN length(merchant_state) > 10 THEN 'merchant_state' END,
  CASE WHEN hour > 23 THEN 'hour' END, CASE WHEN current_age <= 0 OR current_age >= 120 THEN 'current_age' END,
  CASE WHEN gender = 'Other' THEN 'gender' END) AS erreurs
FROM {_REQUEST_SQL} r WHERE NOT ({_VALID_SQL})""")
def quarantined_requests(m: Model):
    return quality.quarantined(m.requests).select("id_transaction", "erreurs")


# --------------------------------------------------------------------- audit


def _after_sql(table: str, key: str, column: str, value: str, columns: str) -> str:
    rest = columns.replace(column, f"CASE WHEN {key} % 10 = 0 THEN {value} ELSE {column} END AS {column}", 1)
    fresh = columns.replace(key, f"{key} + 1000000000 AS {key}", 1)
    return (
        f"(SELECT {rest} FROM {table} WHERE {key} % 97 <> 0 "
        f"UNION ALL SELECT {fresh} FROM {table} WHERE {key} % 50 = 0)"
    )


_CLIENT_COLS = "id_client, current_age, credit_score"
_CLIENT_AFTER = _after_sql("client", "id_client", "credit_score", "coalesce(credit_score, 600) + 1", _CLIENT_COLS)
_CLIENT_CHANGES = f"""
SELECT 'CLIENT' AS table_concernee, coalesce(b.id_client, a.id_client) AS id_ligne_concernee,
  CASE WHEN b.id_client IS NULL THEN 'INSERT' WHEN a.id_client IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
  CASE WHEN a.id_client IS NULL THEN '{{"id_client":' || b.id_client || ',"current_age":' || b.current_age || '}}'
       WHEN b.id_client IS NOT NULL THEN '{{"current_age":' || b.current_age || ',"credit_score":'
            || coalesce(CAST(b.credit_score AS VARCHAR), 'null') || '}}' END AS valeur_avant,
  CASE WHEN b.id_client IS NULL THEN '{{"id_client":' || a.id_client || ',"current_age":' || a.current_age
            || ',"credit_score":' || coalesce(CAST(a.credit_score AS VARCHAR), 'null') || '}}'
       WHEN a.id_client IS NOT NULL THEN '{{"current_age":' || a.current_age || ',"credit_score":'
            || coalesce(CAST(a.credit_score AS VARCHAR), 'null') || '}}' END AS valeur_apres
FROM client b FULL JOIN {_CLIENT_AFTER} a ON b.id_client = a.id_client
WHERE b.id_client IS NULL OR a.id_client IS NULL OR b.credit_score IS DISTINCT FROM a.credit_score"""


@query("client_changes", _CLIENT_CHANGES)
def client_changes(m: Model):
    return audit.changes(m.client, m.client_after, audit.CLIENT)


_CARTE_AFTER = _after_sql(
    "carte", "id_carte", "limit_cents", "limit_cents + 10000", "id_carte, id_client, card_brand, limit_cents, card_on_dark_web"
)


def _limit(alias: str) -> str:
    return f"CAST(CAST({alias}.limit_cents // 100 AS VARCHAR) || '.' || lpad(CAST({alias}.limit_cents % 100 AS VARCHAR), 2, '0') AS VARCHAR)"


_CARTE_CHANGES = f"""
SELECT 'CARTE' AS table_concernee, coalesce(b.id_carte, a.id_carte) AS id_ligne_concernee,
  CASE WHEN b.id_carte IS NULL THEN 'INSERT' WHEN a.id_carte IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
  CASE WHEN a.id_carte IS NULL THEN '{{"id_carte":' || b.id_carte || ',"id_client":' || b.id_client || '}}'
       WHEN b.id_carte IS NOT NULL THEN '{{"credit_limit":' || {_limit('b')} || ',"card_on_dark_web":"'
            || b.card_on_dark_web || '"}}' END AS valeur_avant,
  CASE WHEN b.id_carte IS NULL THEN '{{"id_carte":' || a.id_carte || ',"id_client":' || a.id_client
            || ',"card_brand":"' || a.card_brand || '","credit_limit":' || {_limit('a')} || '}}'
       WHEN a.id_carte IS NOT NULL THEN '{{"credit_limit":' || {_limit('a')} || ',"card_on_dark_web":"'
            || a.card_on_dark_web || '"}}' END AS valeur_apres
FROM carte b FULL JOIN {_CARTE_AFTER} a ON b.id_carte = a.id_carte
WHERE b.id_carte IS NULL OR a.id_carte IS NULL OR b.limit_cents <> a.limit_cents"""


@query("card_changes", _CARTE_CHANGES)
def card_changes(m: Model):
    return audit.changes(m.carte, m.carte_after, audit.CARTE)


_USER_AFTER = _after_sql("utilisateur", "id_utilisateur", "role", "'audit'", "id_utilisateur, login, role, actif")
_USER_CHANGES = f"""
SELECT 'UTILISATEUR_SI' AS table_concernee,
  CAST(coalesce(b.id_utilisateur, a.id_utilisateur) AS BIGINT) AS id_ligne_concernee,
  CASE WHEN b.login IS NULL THEN 'INSERT' WHEN a.login IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
  CASE WHEN a.login IS NULL THEN '{{"login":"' || b.login || '"}}'
       WHEN b.login IS NOT NULL THEN '{{"role":"' || b.role || '","actif":"' || b.actif || '"}}' END AS valeur_avant,
  CASE WHEN b.login IS NULL THEN '{{"login":"' || a.login || '","role":"' || a.role || '"}}'
       WHEN a.login IS NOT NULL THEN '{{"role":"' || a.role || '","actif":"' || a.actif || '"}}' END AS valeur_apres
FROM utilisateur b FULL JOIN {_USER_AFTER} a ON b.id_utilisateur = a.id_utilisateur
WHERE b.login IS NULL OR a.login IS NULL OR b.role <> a.role"""


@query("user_changes", _USER_CHANGES)
def user_changes(m: Model):
    return audit.changes(m.utilisateur_si, m.utilisateur_si_after, audit.UTILISATEUR_SI)


def _journal(m: Model):
    rows = (
        audit.changes(m.client, m.client_after, audit.CLIENT)
        .unionByName(audit.changes(m.carte, m.carte_after, audit.CARTE))
        .unionByName(audit.changes(m.utilisateur_si, m.utilisateur_si_after, audit.UTILISATEUR_SI))
    )
    return audit.stamped(rows, F.lit(0), F.expr("timestamp '2024-06-01 00:00:00'"))


@query("audit_report", f"""
SELECT table_concernee, operation, count(*) AS nb
FROM ({_CLIENT_CHANGES} UNION ALL {_CARTE_CHANGES} UNION ALL {_USER_CHANGES}) GROUP BY table_concernee, operation""")
def audit_report(m: Model):
    return listing.count_by(_journal(m), "table_concernee", "operation")


@query("table_counts", f"""
SELECT 'MCC' AS nom_table, count(*) AS nb_lignes FROM mcc UNION ALL SELECT 'CLIENT', count(*) FROM client
UNION ALL SELECT 'CARTE', count(*) FROM carte UNION ALL SELECT 'MARCHAND', count(*) FROM marchand
UNION ALL SELECT 'TRANSACTION', count(*) FROM tx UNION ALL SELECT 'LABEL_FRAUDE', count(*) FROM label
UNION ALL SELECT 'UTILISATEUR_SI', count(*) FROM utilisateur
UNION ALL SELECT 'ERREUR_TRANSACTION', count(*) FROM {_ERRORS_SQL} e
UNION ALL SELECT 'JOURNAL_AUDIT', count(*) FROM ({_CLIENT_CHANGES} UNION ALL {_CARTE_CHANGES} UNION ALL {_USER_CHANGES}) j""")
def table_counts(m: Model):
    return listing.table_counts(
        {
            "MCC": m.mcc, "CLIENT": m.client, "CARTE": m.carte, "MARCHAND": m.marchand,
            "TRANSACTION": m.transaction, "LABEL_FRAUDE": m.label_fraude,
            "UTILISATEUR_SI": m.utilisateur_si, "ERREUR_TRANSACTION": derive.error_rows(m.error_texts),
            "JOURNAL_AUDIT": _journal(m),
        }
    )


@query("audit_history", f"""
SELECT table_concernee, id_ligne_concernee, operation, valeur_avant, valeur_apres,
       '2024-06-01 00:00:00' AS date_operation
FROM ({_CLIENT_CHANGES}) WHERE id_ligne_concernee = 10""")
def audit_history(m: Model):
    return audit.history_of(_journal(m), "CLIENT", 10).select(
        "table_concernee", "id_ligne_concernee", "operation", "valeur_avant", "valeur_apres", "date_operation"
    )


@query("client_merged", f"""
SELECT a.id_client, a.current_age, CAST(a.credit_score AS DOUBLE) AS credit_score,
       CASE WHEN b.id_client IS NOT NULL AND a.credit_score IS DISTINCT FROM b.credit_score
            THEN '2024-06-01 00:00:00' END AS date_modification
FROM {_CLIENT_AFTER} a LEFT JOIN client b ON a.id_client = b.id_client""")
def client_merged(m: Model):
    rows = audit.merged(m.client, m.client_after, "id_client", F.expr("timestamp '2024-06-01 00:00:00'"))
    return _score_as_double(rows).select("id_client", "current_age", "credit_score", "date_modification")
