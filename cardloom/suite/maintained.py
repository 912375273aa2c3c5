"""Stored tables that are kept up to date: late labels, corrections, deletions, merged bitmaps."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.operators import history, listing, quality
from cardloom.operators.skew import planned_bytes
from cardloom.plans import bitmaps, removal
from cardloom.plans.deltas import Deltas
from cardloom.plans.toplist import TopList
from cardloom.sources import layout, tables
from cardloom.suite import landing
from cardloom.suite.base import Model, day_sql, mean_sql, money_sql, query, rate_sql, time_sql

# What the batches below leave: one id in 23 deleted (every second of them comes back), one in 17 with another amount,
# one in 19 on another card, labels after or before their transactions, some changed twice
_NOW = """(SELECT tx.id_transaction, tx.id_carte + CASE WHEN tx.id_transaction % 19 = 0 THEN 1 ELSE 0 END AS id_carte,
  tx.id_marchand, tx.situation_date, tx.cents + CASE WHEN tx.id_transaction % 17 = 0 THEN 100 ELSE 0 END AS cents,
  CASE WHEN tx.id_transaction % 31 = 0 THEN 'N' WHEN tx.id_transaction % 29 = 0 THEN 'Y' ELSE label.is_fraud END AS is_fraud
FROM tx LEFT JOIN label USING (id_transaction) WHERE tx.id_transaction % 23 <> 0 OR tx.id_transaction % 46 = 0) now"""
_N, _TOTAL = "count(*)", "sum(cents)"
_FRAUDS = "CAST(sum(CASE WHEN is_fraud = 'Y' THEN 1 ELSE 0 END) AS BIGINT)"


def _late(m: Model) -> Deltas:
    def write(root: str) -> None:
        i = F.col("id_transaction")
        fields = ["id_transaction", "id_carte", "id_marchand", "situation_date", "amount"]
        # the batches read it many times
        lines = landing.parquet(m, "late_lines", m.labelled_transaction.select(*fields, "is_fraud"))
        tx, label = lines.select(*fields), lines.where("is_fraud is not null").select("id_transaction", "is_fraud")
        now = tx.withColumn("amount", F.when(i % 17 == 0, F.col("amount") + 1).otherwise(F.col("amount"))).withColumn(
            "id_carte", F.when(i % 19 == 0, F.col("id_carte") + 1).otherwise(F.col("id_carte"))
        )
        none, ids = label.limit(0), tx.select("id_transaction")
        changed = lambda k, to: ids.where(i % k == 0).select("id_transaction", F.lit(to).alias("is_fraud"))
        state = Deltas(m.spark, root, parts=8)
        state.apply("0001", tx.where(i % 3 != 0), label.where(i % 2 == 0), ids.limit(0), m.marchand)
        fresh = now.where((i % 3 == 0) | (i % 17 == 0) | (i % 19 == 0))
        state.apply("0002", fresh, label.where((i % 2 == 1) & (i % 29 != 0)).unionByName(changed(29, "Y")), ids.limit(0), m.marchand)
        state.apply("0003", tx.limit(0), changed(31, "N"), ids.where(i % 23 == 0), m.marchand)
        state.apply("0004", now.where(i % 46 == 0), none, ids.limit(0), m.marchand)

    return Deltas(m.spark, landing.once(m, "late", write), parts=8)


@query("late_labels_datamart", f"""
SELECT id_carte, {_N} AS nb_transactions, {money_sql(_TOTAL)} AS total_amount, {mean_sql(_TOTAL, _N)} AS avg_amount,
       {_FRAUDS} AS nb_fraudes, {rate_sql(_FRAUDS, _N)} AS taux_fraude_pct
FROM {_NOW} GROUP BY id_carte""")
def late_labels_datamart(m: Model):
    """Card datamart after four batches of new, corrected, late-labelled and deleted transactions."""
    return _late(m).card_datamart()


@query("late_labels_daily", f"""
SELECT {day_sql('situation_date')} AS situation_date, {_N} AS nb_tx, {money_sql(_TOTAL)} AS total_amount,
       {mean_sql(_TOTAL, _N)} AS avg_amount, {_FRAUDS} AS nb_fraudes, {rate_sql(_FRAUDS, _N)} AS taux_fraude_pct
FROM {_NOW} GROUP BY situation_date""")
def late_labels_daily(m: Model):
    return _late(m).daily_datamart()


@query("late_labels_category", f"""
SELECT code_mcc, libelle_mcc, {_N} AS nb_transactions, {money_sql(_TOTAL)} AS total_amount, {mean_sql(_TOTAL, _N)} AS avg_amount,
       count(DISTINCT id_carte) AS nb_cartes_uniques
FROM {_NOW} JOIN marchand USING (id_marchand) JOIN mcc USING (code_mcc) GROUP BY code_mcc, libelle_mcc""")
def late_labels_category(m: Model):
    """Distinct cards stay exact although rows and cards leave."""
    return _late(m).category_datamart(m.mcc)


@query("merged_distinct_cards", """
SELECT code_mcc, count(DISTINCT id_carte) AS nb_cartes_uniques FROM tx JOIN marchand USING (id_marchand) GROUP BY code_mcc""")
def merged_distinct_cards(m: Model):
    """Distinct cards per category from the bitmaps of three batches, the second of which comes twice."""

    def write(root: str) -> None:
        year = F.year("situation_date")
        stored = bitmaps.table(m.spark, root, parts=8)
        for batch, part in (("0001", year < 1995), ("0002", year.between(1995, 1996)), ("0002", year.between(1995, 1996)), ("0003", year > 1996)):
            bitmaps.merge(stored, batch, bitmaps.of_batch(m.transaction.where(part), m.marchand))

    return bitmaps.distinct_cards(bitmaps.table(m.spark, landing.once(m, "bitmaps", write), parts=8))


@query("maintained_top_cards", f"""
SELECT id_carte, {_N} AS nb_transactions FROM {_NOW} GROUP BY id_carte ORDER BY nb_transactions DESC, id_carte LIMIT 10""")
def maintained_top_cards(m: Model):
    """The ten busiest cards after the four batches, from the list that each batch updated."""
    state = _late(m)

    def write(root: str) -> None:
        top = TopList(m.spark, root)
        for batch in state.card.versions():
            top.update(batch, state.changed_cards(batch), state.all_cards(batch))

    return TopList(m.spark, landing.once(m, "top", write)).shown().select(F.col("key").alias("id_carte"), F.col("figure").alias("nb_transactions"))


# ----------------------------------------------------------- planted faults

# Per table: its SQL, its key, and for every rule the column and value that break it. Rule j is broken in the rows whose key is j modulo the
# number of rules.
_NULL = "NULL"
_FAULTS = {
    "mcc": ("mcc", "code_mcc", {"code_mcc not null": ("code_mcc", _NULL), "libelle_mcc not null": ("libelle_mcc", _NULL), "code 0..9999": ("code_mcc", "10000")}),
    "utilisateur_si": ("utilisateur", "id_utilisateur", {
        **{f"{c} not null": (c, _NULL) for c in ("id_utilisateur", "login", "nom_complet", "email", "role", "actif")}, "role known": ("role", "'root'"), "actif Y/N": ("actif", "'y'"),
    }),
    "client": ("client", "id_client", {
        **{f"{c} not null": (c, _NULL) for c in ("id_client", "num_credit_cards", "current_age", "birth_year")},
        "current_age 1..129": ("current_age", "130"), "retirement_age 1..129": ("retirement_age", "0"), "birth_year from 1900": ("birth_year", "1899"),
        "birth_month 1..12": ("birth_month", "13"), "gender known": ("gender", "'?'"), "latitude -90..90": ("latitude", "90.5"), "longitude -180..180": ("longitude", "-181"),
        "credit_score 300..850": ("credit_score", "851"), "num_credit_cards from 0": ("num_credit_cards", "-1"),
    }),
    "marchand": ("marchand", "id_marchand", {f"{c} not null": (c, _NULL) for c in ("id_marchand", "code_mcc")}),
    "carte": ("carte", "id_carte", {
        **{f"{c} not null": (c, _NULL) for c in ("id_carte", "id_client", "card_brand", "card_type", "expires", "acct_open_date", "has_chip", "card_on_dark_web")},
        "has_chip Y/N": ("has_chip", "'YES'"), "card_on_dark_web Y/N": ("card_on_dark_web", "''"), "credit_limit from 0": ("credit_limit", "-0.01"),
        "num_cards_issued from 0": ("num_cards_issued", "-1"), "year_pin from 1900": ("year_pin_last_changed", "1899"),
    }),
    "transaction": ("tx", "id_transaction", {
        **{f"{c} not null": (c, _NULL) for c in ("id_transaction", "id_carte", "id_marchand", "date_transaction", "amount", "situation_date")}, "use_chip known": ("use_chip", "'Chip'"),
    }),
    "label_fraude": ("label", "id_transaction", {"id_transaction not null": ("id_transaction", _NULL), "is_fraud not null": ("is_fraud", _NULL), "is_fraud Y/N": ("is_fraud", "'N '")}),
    "erreur_transaction": ("(SELECT * FROM tx WHERE id_transaction % 7 = 3) e", "id_transaction", {f"{c} not null": (c, _NULL) for c in ("id_erreur", "id_transaction", "code_erreur")}),
    "journal_audit": ("client", "id_client", {
        **{f"{c} not null": (c, _NULL) for c in ("id_audit", "id_utilisateur", "table_concernee", "id_ligne_concernee", "operation")}, "operation known": ("operation", "'MERGE'"),
    }),
}


def _faulty_tables(m: Model) -> dict[str, DataFrame]:
    t = {
        "mcc": m.mcc, "utilisateur_si": m.utilisateur_si, "client": m.client, "marchand": m.marchand, "carte": m.carte, "transaction": m.transaction,
        "label_fraude": m.label_fraude,
        "erreur_transaction": m.transaction.where("id_transaction % 7 = 3").select((F.col("id_transaction") * 100).alias("id_erreur"), "id_transaction", F.lit("Bad PIN").alias("code_erreur")),
        "journal_audit": m.client.select(
            "id_client", F.col("id_client").alias("id_audit"), F.lit(1).alias("id_utilisateur"), F.lit("client").alias("table_concernee"),
            F.col("id_client").alias("id_ligne_concernee"), F.lit("UPDATE").alias("operation"),
        ),
    }
    out = {}
    for name, df in t.items():
        _, key, faults = _FAULTS[name]
        kinds, changes = dict(df.dtypes), {}
        for j, (column, value) in enumerate(faults.values()):
            given = changes.get(column, F.col(column))
            changes[column] = F.when(F.col(key) % len(faults) == j, F.expr(value).cast(kinds[column])).otherwise(given)
        out[name] = df.select(*[changes.get(c, F.col(c)).alias(c) for c in df.columns])
    return out


@query("planted_violations", " UNION ALL ".join(
    f"SELECT '{name}' AS nom_table, '{rule}' AS regle, (SELECT count(*) FROM {source} WHERE {key} % {len(faults)} = {j}) AS violations, (SELECT count(*) FROM {source}) AS lignes"
    for name, (source, key, faults) in _FAULTS.items() for j, rule in enumerate(faults)
))
def planted_violations(m: Model):
    """All rules of the nine tables, each broken in some rows."""
    return reduce(DataFrame.unionByName, [quality.check_rules(df, name) for name, df in _faulty_tables(m).items()])


# columns that the SQL of a table names otherwise
_GIVEN = {
    ("journal_audit", "id_audit"): "id_client", ("journal_audit", "id_utilisateur"): "1",
    ("erreur_transaction", "id_erreur"): "id_transaction * 100", ("utilisateur_si", "email"): "login || '@bank.example'",
}


def _faulty_sql(name: str, column: str) -> str:
    """Values of one column after the faults were planted, as ``k``."""
    source, key, faults = _FAULTS[name]
    value = _GIVEN.get((name, column), column)
    for j, (changed, bad) in enumerate(faults.values()):
        if changed == column:
            value = f"CASE WHEN {key} % {len(faults)} = {j} THEN {bad} ELSE {value} END"
    return f"(SELECT {value} AS k FROM {source})"


_SUITE_SQL = [
    f"SELECT 'regle' AS famille, '{name}' AS nom_table, '{rule}' AS regle, (SELECT count(*) FROM {source} WHERE {key} % {len(faults)} = {j}) AS violations"
    for name, (source, key, faults) in _FAULTS.items() for j, rule in enumerate(faults)
] + [
    f"SELECT 'doublon', '{name}', '{key}', (SELECT count(*) - count(DISTINCT k) - CASE WHEN count(*) > count(k) THEN 1 ELSE 0 END FROM {_faulty_sql(name, key)})"
    for name, key in quality.PRIMARY_KEYS.items()
] + [
    f"SELECT 'doublon', '{name}', '{key}', (SELECT count(k) - count(DISTINCT k) FROM {_faulty_sql(name, key)})"
    for name, keys in quality.UNIQUE_COLUMNS.items() for key in keys
] + [
    f"SELECT 'orphelin', '{child}', '{key}', (SELECT count(*) FROM {_faulty_sql(child, key)} c WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_faulty_sql(parent, parent_key)} p WHERE p.k = c.k))"
    for child, key, parent, parent_key in quality.FOREIGN_KEYS
]


@query("planted_suite", " UNION ALL ".join(_SUITE_SQL))
def planted_suite(m: Model):
    """The whole report on nine tables with faults: broken rules, keys missing or repeated, children that lost their parents."""
    return quality.suite(_faulty_tables(m))


# ------------------------------------------------------------------ removal


@query("expired_transactions", f"""
SELECT id_transaction, id_carte, {day_sql('situation_date')} AS situation_date FROM tx
WHERE situation_date >= DATE '2000-05-17' - 730""")
def expired_transactions(m: Model):
    """What the stored monthly table holds after its retention ran."""

    def write(path: str) -> None:
        tables.write_monthly(m.transaction, path)
        removal.expire(m.spark, path, date(2000, 5, 17))

    rows = m.spark.read.parquet(landing.once(m, "expired", write))
    return rows.select("id_transaction", "id_carte", "situation_date")


def _erased(m: Model) -> str:
    def write(root: str) -> None:
        for name, df in (("client", m.client), ("carte", m.carte), ("label_fraude", m.label_fraude)):
            df.write.parquet(f"{root}/{name}")
        tables.write_monthly(m.transaction, f"{root}/transaction")
        removal.erase_clients(m.spark, root, m.client.where(F.col("current_age") == 30), "r1")
        # the same clients once more: nothing is left to remove
        removal.erase_clients(m.spark, root, m.client.where(F.col("current_age") == 30), "r2")

    return landing.once(m, "erased", write)


_KEPT = "WHERE current_age IS DISTINCT FROM 30"


@query("stored_erasure", f"""
SELECT 'client' AS nom_table, id_client AS cle FROM client {_KEPT}
UNION ALL SELECT 'carte', id_carte FROM carte LEFT JOIN client USING (id_client) {_KEPT}
UNION ALL SELECT 'transaction', id_transaction FROM tx LEFT JOIN carte USING (id_carte) LEFT JOIN client USING (id_client) {_KEPT}
UNION ALL SELECT 'label_fraude', id_transaction FROM label JOIN tx USING (id_transaction) LEFT JOIN carte USING (id_carte)
  LEFT JOIN client USING (id_client) {_KEPT}""")
def stored_erasure(m: Model):
    """Keys in the stored tables after the clients of one age were erased from them."""
    root = _erased(m)
    keys = {"client": "id_client", "carte": "id_carte", "transaction": "id_transaction", "label_fraude": "id_transaction"}
    return reduce(DataFrame.unionByName, [
        m.spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("nom_table"), F.col(k).cast("bigint").alias("cle")) for n, k in keys.items()
    ])


@query("erasure_journal", """
SELECT r AS id_run, nom_table, CASE WHEN r = 'r1' THEN lignes ELSE 0 END AS lignes FROM (VALUES ('r1'), ('r2')) v(r), (
  SELECT 'client' AS nom_table, count(*) AS lignes FROM client WHERE current_age = 30
  UNION ALL SELECT 'carte', count(*) FROM carte JOIN client USING (id_client) WHERE current_age = 30
  UNION ALL SELECT 'transaction', count(*) FROM tx JOIN carte USING (id_carte) JOIN client USING (id_client) WHERE current_age = 30
  UNION ALL SELECT 'label_fraude', count(*) FROM label JOIN tx USING (id_transaction) JOIN carte USING (id_carte)
    JOIN client USING (id_client) WHERE current_age = 30) n""")
def erasure_journal(m: Model):
    """Rows that each run removed per table."""
    return removal.journal(m.spark, _erased(m)).select("id_run", "nom_table", "lignes")


# ------------------------------------------------------------------- layout

#: Bytes of the given fact for one file of documents; a file is sorted in one task.
FILE_BYTES = 8 << 20


def _files(m: Model) -> int:
    """Files of documents: more for a larger fact, so that a task sorts no more of it."""
    return max(32, -(-planned_bytes(m.given("lineitem")) // FILE_BYTES))


_LAID = ["client.id_client", "mcc.code", "date_transaction", "carte.id_carte"]


def _laid_out(m: Model) -> DataFrame:
    path = landing.once(m, "interleaved", lambda p: layout.write_interleaved(m.docs, p, _LAID, ["id_transaction", "carte.id_carte"], files=_files(m)))
    return tables.read_documents(m.spark, path)


@query("interleaved_filters", """
SELECT 'client' AS filtre, count(*) AS nb, coalesce(sum(id_transaction), 0)::BIGINT AS somme FROM flat WHERE id_client = 8
UNION ALL SELECT 'carte', count(*), coalesce(sum(id_transaction), 0)::BIGINT FROM flat WHERE id_carte = 13
UNION ALL SELECT 'categorie', count(*), coalesce(sum(id_transaction), 0)::BIGINT FROM flat WHERE code_mcc = 7
UNION ALL SELECT 'fraude', count(*), coalesce(sum(id_transaction), 0)::BIGINT FROM flat WHERE is_fraud = 'Y'
UNION ALL SELECT 'dates', count(*), coalesce(sum(id_transaction), 0)::BIGINT FROM flat
  WHERE date_transaction BETWEEN TIMESTAMP '1998-02-01' AND TIMESTAMP '1998-03-31'
UNION ALL SELECT 'toutes', count(*), coalesce(sum(id_transaction), 0)::BIGINT FROM flat""")
def interleaved_filters(m: Model):
    """Every filter alone over documents laid out for all of them: rows and sum of ids."""
    docs = _laid_out(m)
    f = listing.transaction_filter
    conditions = {
        "client": f(id_client=8), "carte": f(id_carte=13), "categorie": f(code_mcc=7), "fraude": f(is_fraud=True),
        "dates": f(date_from=datetime(1998, 2, 1), date_to=datetime(1998, 3, 31)), "toutes": f(),
    }
    sums = [F.count(F.lit(1)).alias("nb"), F.coalesce(F.sum("id_transaction"), F.lit(0)).alias("somme")]
    return reduce(DataFrame.unionByName, [docs.where(c).agg(*sums).select(F.lit(n).alias("filtre"), "nb", "somme") for n, c in conditions.items()])


@query("numbered_deep_page", f"""
SELECT id_transaction, {time_sql('date_transaction')} AS date_transaction FROM flat
ORDER BY flat.date_transaction DESC, id_transaction LIMIT 20 OFFSET 39980""")
def numbered_deep_page(m: Model):
    """Page 2 000 by number, by way of the directory of files."""

    def write(root: str) -> None:
        layout.write_paged(m.docs, f"{root}/docs", f"{root}/directory", files=_files(m))

    root = landing.once(m, "paged", write)
    return layout.numbered_page(m.spark, f"{root}/docs", f"{root}/directory", 2000).select("id_transaction", "date_transaction")


# ------------------------------------------------------------------ history

_DAYS = ("2024-01-01", "2024-02-01", "2024-03-01")
_STATE = ["credit_score", "num_credit_cards"]
_LAST_SQL = """(SELECT id_client, CASE WHEN id_client % 20 = 0 THEN credit_score + 1 ELSE credit_score END AS credit_score, num_credit_cards
FROM second WHERE id_client % 13 <> 0 UNION ALL SELECT id_client, credit_score, num_credit_cards FROM client WHERE id_client % 97 = 0)"""
_CHAIN = f"""(WITH first AS (SELECT id_client, credit_score, num_credit_cards FROM client),
second AS (SELECT id_client, CASE WHEN id_client % 10 = 0 THEN coalesce(credit_score, 600) + 1 ELSE credit_score END AS credit_score, num_credit_cards
  FROM client WHERE id_client % 97 <> 0
  UNION ALL SELECT id_client + 1000000000, credit_score, num_credit_cards FROM client WHERE id_client % 50 = 0)
SELECT 1 AS jour, * FROM first UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM {_LAST_SQL} last)"""


def _snapshots(m: Model) -> dict[str, DataFrame]:
    """Three snapshots: changes, keys that go, come and come back."""
    k = F.col("id_client")
    second = m.client_after.select("id_client", *_STATE)
    third = second.where(k % 13 != 0).withColumn("credit_score", F.when(k % 20 == 0, F.col("credit_score") + 1).otherwise(F.col("credit_score")))
    back = m.client.where(k % 97 == 0).select("id_client", *_STATE)
    return dict(zip(_DAYS, (m.client.select("id_client", *_STATE), second, third.unionByName(back)), strict=True))


def _history(m: Model) -> DataFrame:
    rows = history.versions(history.stacked(_snapshots(m)), "id_client", _STATE, list(_DAYS))
    return landing.parquet(m, "client-versions", rows)


@query("client_history_days", f"""
SELECT jour_du, id_client, credit_score, num_credit_cards FROM (
  SELECT CASE jour WHEN 1 THEN '2024-01-15' WHEN 2 THEN '2024-02-01' ELSE '2024-12-31' END AS jour_du, id_client, credit_score, num_credit_cards FROM {_CHAIN} c)""")
def client_history_days(m: Model):
    """The state of all clients on three days, looked up in the history: each day's equals its snapshot."""
    days = ("2024-01-15", "2024-02-01", "2024-12-31")
    return reduce(DataFrame.unionByName, [
        history.as_of(_history(m), F.lit(d).cast("date")).select(F.lit(d).alias("jour_du"), "id_client", *_STATE) for d in days
    ])


@query("client_versions", f"""
SELECT id_client, credit_score, num_credit_cards, CASE jour WHEN 1 THEN '2024-01-01' WHEN 2 THEN '2024-02-01' ELSE '2024-03-01' END AS valide_du,
       CASE fin WHEN 2 THEN '2024-02-01' WHEN 3 THEN '2024-03-01' END AS valide_au FROM (
  SELECT *, CASE WHEN coalesce(lead(jour) OVER (PARTITION BY id_client ORDER BY jour), 9) = suivant THEN lead(jour) OVER (PARTITION BY id_client ORDER BY jour)
                 WHEN dernier < 3 THEN dernier + 1 END AS fin FROM (
    SELECT id_client, credit_score, num_credit_cards, min(jour) AS jour, max(jour) AS dernier, max(jour) + 1 AS suivant FROM (
      SELECT *, sum(neuf) OVER (PARTITION BY id_client ORDER BY jour) AS ile FROM (
        SELECT *, CASE WHEN lag(jour) OVER k = jour - 1 AND lag(credit_score) OVER k IS NOT DISTINCT FROM credit_score
                        AND lag(num_credit_cards) OVER k IS NOT DISTINCT FROM num_credit_cards THEN 0 ELSE 1 END AS neuf
        FROM {_CHAIN} c WINDOW k AS (PARTITION BY id_client ORDER BY jour)))
    GROUP BY id_client, credit_score, num_credit_cards, ile))""")
def client_versions(m: Model):
    return _history(m)


@query("transactions_with_client_state", f"""
SELECT id_transaction, id_client, h.credit_score AS score FROM (
  SELECT tx.id_transaction, carte.id_client, 1 + (tx.id_transaction % 3)::INT AS jour FROM tx JOIN carte USING (id_carte)) f
LEFT JOIN {_CHAIN} h USING (id_client, jour)""")
def transactions_with_client_state(m: Model):
    """Each transaction with its client's state as of a day within the chain of snapshots (a third of them in each month)."""
    day = F.element_at(F.array(*[F.lit(d).cast("date") for d in ("2024-01-20", "2024-02-20", "2024-03-20")]), (F.col("id_transaction") % 3 + 1).cast("int"))
    facts = m.transaction.join(m.carte.select("id_carte", "id_client"), "id_carte").select("id_transaction", "id_client", day.alias("jour"))
    return history.joined_as_of(facts, _history(m), "id_client", "jour").select("id_transaction", "id_client", F.col("credit_score").alias("score"))
