"""Filters, pages, top-k lists and activity statistics over documents."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions.clean import moment
from cardloom.functions.exact import rate_pct
from cardloom.operators.datamarts import CARD_METRICS
from cardloom.schemas import GENDERS, USE_CHIP_VALUES

# Lower edges of the age classes; 130 and above is "unknown".
AGE_EDGES = (0, 25, 35, 45, 55, 65, 130)


def transaction_filter(
    id_client: int | None = None,
    id_carte: int | None = None,
    code_mcc: int | None = None,
    is_fraud: bool | None = None,
    date_from: datetime | date | None = None,
    date_to: datetime | date | None = None,
) -> Column:
    """Conjunction of the filters that are given. Both dates are inclusive;
    ``is_fraud=False`` leaves unlabelled rows out."""
    terms = [F.lit(True)]
    for path, value in (
        ("client.id_client", id_client),
        ("carte.id_carte", id_carte),
        ("mcc.code", code_mcc),
        ("fraude.is_fraud", is_fraud),
    ):
        if value is not None:
            terms.append(F.col(path) == F.lit(value))
    if date_from is not None:
        terms.append(F.col("date_transaction") >= moment(date_from))
    if date_to is not None:
        terms.append(F.col("date_transaction") <= moment(date_to))
    return reduce(lambda a, b: a & b, terms)


def find_transaction(docs: DataFrame, id_transaction: int) -> DataFrame:
    """The document with this id, or no row."""
    return docs.where(F.col("id_transaction") == id_transaction).drop("_ingested_at")


def one_fraud(docs: DataFrame) -> DataFrame:
    """One fraud document, the one with the smallest id."""
    return docs.where(F.col("fraude.is_fraud")).orderBy("id_transaction").limit(1)


def page(docs: DataFrame, condition: Column, number: int = 1, size: int = 20) -> DataFrame:
    """Page ``number`` of the matching rows, newest first, ties by id.

    Planned as a distributed top-k of number*size rows; for deep pages use
    ``page_after``, which never sorts the skipped rows.
    """
    if number < 1 or not 1 <= size <= 200:
        raise ValueError("page starts at 1, page size is 1..200")
    return (
        docs.where(condition)
        .drop("_ingested_at")
        .orderBy(F.desc("date_transaction"), "id_transaction")
        .offset((number - 1) * size)
        .limit(size)
    )


def page_after(docs: DataFrame, condition: Column, last_date: datetime, last_id: int, size: int = 20) -> DataFrame:
    """Next page behind the row (last_date, last_id) of the previous one."""
    d, i, last = F.col("date_transaction"), F.col("id_transaction"), moment(last_date)
    behind = (d < last) | ((d == last) & (i > last_id))
    return page(docs, condition & (d <= last) & behind, 1, size)


def total(docs: DataFrame, condition: Column) -> DataFrame:
    """Exact number of matching rows."""
    return docs.where(condition).agg(F.count(F.lit(1)).alias("total"))


def latest_per_client(docs: DataFrame, k: int = 5) -> DataFrame:
    """Newest k transactions of every client. The rank filter is applied within
    each map task too, so at most k rows per client and task are shuffled."""
    newest = Window.partitionBy("id_client").orderBy(F.desc("date_transaction"), "id_transaction")
    return (
        docs.select("client.id_client", "id_transaction", "date_transaction", "amount")
        .withColumn("rang", F.row_number().over(newest))
        .where(F.col("rang") <= k)
    )


def ranked_cards(
    card_mart: DataFrame,
    by: str = "nb_transactions",
    descending: bool = True,
    limit: int = 20,
    min_transactions: int = 0,
) -> DataFrame:
    """Cards by an allowed metric, with a lower bound on their transactions."""
    if by not in CARD_METRICS:
        raise ValueError(f"sort key must be one of {CARD_METRICS}")
    rows = card_mart.where(F.col("nb_transactions") >= min_transactions) if min_transactions > 0 else card_mart
    return rows.orderBy(F.desc(by) if descending else F.asc(by), "id_carte").limit(limit)


def top_categories(category_mart: DataFrame, limit: int = 10) -> DataFrame:
    return category_mart.orderBy(F.desc("nb_transactions"), "code_mcc").limit(limit)


def _activity(docs: DataFrame) -> DataFrame:
    # first per (client, card), so that the distinct cards are a plain count
    per_card = docs.groupBy(
        F.col("client.id_client").alias("id_client"), F.col("carte.id_carte").alias("id_carte")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("s"),
        F.sum(F.when(F.col("fraude.is_fraud"), 1).otherwise(0)).alias("f"),
    )
    return per_card.groupBy("id_client").agg(
        F.sum("n").alias("nb_transactions"),
        F.sum("s").cast("decimal(32,2)").alias("total_amount"),
        F.sum("f").alias("nb_fraudes"),
        F.count("id_carte").alias("nb_cartes_utilisees"),
    )


def client_summary(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Activity of each client in ``wanted`` (column id_client); zeros when there is none."""
    activity = _activity(docs)
    return wanted.select("id_client").join(activity, "id_client", "left").select(
        "id_client",
        F.coalesce("nb_transactions", F.lit(0)).alias("nb_transactions"),
        F.coalesce("total_amount", F.lit(0)).cast("decimal(32,2)").alias("total_amount"),
        F.coalesce("nb_fraudes", F.lit(0)).alias("nb_fraudes"),
        F.coalesce("nb_cartes_utilisees", F.lit(0)).alias("nb_cartes_utilisees"),
    )


def age_class(age: Column) -> Column:
    """Lower edge of the class as text; the last upper edge is outside."""
    label = F.when(age.isNull() | (age < AGE_EDGES[0]) | (age >= AGE_EDGES[-1]), "unknown")
    for low, high in zip(AGE_EDGES, AGE_EDGES[1:]):
        label = label.when((age >= low) & (age < high), str(low))
    return label


def known(x: Column) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("Unknown"))


def fraud_facets(docs: DataFrame) -> DataFrame:
    """Frauds by gender, age class and payment type in one pass: (facet, cle, nb)."""
    frauds = docs.where(F.col("fraude.is_fraud")).select(
        known(F.col("client.gender")).alias("g"),
        age_class(F.col("client.current_age")).alias("a"),
        known(F.col("use_chip")).alias("p"),
    )
    which = F.grouping_id()
    return (
        frauds.groupingSets([[F.col("g")], [F.col("a")], [F.col("p")]], "g", "a", "p")
        .agg(F.count(F.lit(1)).alias("nb"), which.alias("w"))
        .select(
            F.when(F.col("w") == 3, "par_genre")
            .when(F.col("w") == 5, "par_tranche_age")
            .otherwise("par_type_paiement")
            .alias("facet"),
            F.when(F.col("w") == 3, F.col("g"))
            .when(F.col("w") == 5, F.col("a"))
            .otherwise(F.col("p"))
            .alias("cle"),
            "nb",
        )
    )


def age_classes(docs: DataFrame) -> DataFrame:
    """Frauds per age class; classes without fraud do not appear."""
    return (
        docs.where(F.col("fraude.is_fraud"))
        .groupBy(age_class(F.col("client.current_age")).alias("tranche"))
        .agg(F.count(F.lit(1)).alias("nb"))
    )


def fraud_stats(docs: DataFrame) -> DataFrame:
    """One row: totals, global rate and two maps.

    The maps count frauds for the values of the contract and ``Unknown`` (null or
    empty); all values outside it are counted together as ``Hors contrat``. Keys
    without frauds are left out. ``fraud_facets`` gives every value, as rows.
    """
    fraud = F.coalesce(F.col("fraude.is_fraud"), F.lit(False))
    facets = {"par_genre": (F.col("client.gender"), GENDERS), "par_type_paiement": (F.col("use_chip"), USE_CHIP_VALUES)}
    maps = []
    for name, (value, allowed) in facets.items():
        key = F.when(known(value).isin(*allowed, "Unknown"), known(value)).otherwise("Hors contrat")
        counts = [x for k in sorted([*allowed, "Unknown", "Hors contrat"]) for x in (F.lit(k), F.count_if(fraud & (key == k)))]
        maps.append(F.map_filter(F.create_map(*counts), lambda _, n: n > 0).alias(name))
    totals = docs.agg(F.count(F.lit(1)).alias("total_transactions"), F.count_if(fraud).alias("nb_fraudes"), *maps)
    rate = rate_pct(F.col("nb_fraudes"), F.col("total_transactions"))
    return totals.select(
        "total_transactions", "nb_fraudes", F.coalesce(rate, F.lit(0).cast("decimal(9,4)")).alias("taux_global_pct"), *facets,
    )


def collection_report(docs: DataFrame) -> DataFrame:
    """One row: documents, frauds, share of frauds (3 digits), distinct cards, clients, merchants.

    Rows are grouped once by card and client and once by merchant; the distinct
    numbers are counts of these groups.
    """
    held = docs.groupBy("carte.id_carte", "client.id_client").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("fraude.is_fraud"), F.lit(False))).alias("f")
    )
    by_card = held.groupBy("id_carte").agg(F.sum("n").alias("n"), F.sum("f").alias("f"))
    none = F.lit(0).cast("bigint")
    parts = [
        by_card.agg(F.sum("n").alias("total"), F.sum("f").alias("fraudes"), F.count("id_carte").alias("cartes"), none.alias("clients"), none.alias("marchands")),
        held.select("id_client").distinct().agg(none.alias("total"), none.alias("fraudes"), none.alias("cartes"), F.count("id_client").alias("clients"), none.alias("marchands")),
        docs.select("marchand.id_marchand").distinct().agg(none.alias("total"), none.alias("fraudes"), none.alias("cartes"), none.alias("clients"), F.count("id_marchand").alias("marchands")),
    ]
    names = ("total", "fraudes", "cartes", "clients", "marchands")
    whole = reduce(DataFrame.unionByName, parts).agg(*[F.coalesce(F.sum(c), none).alias(c) for c in names])
    share = F.call_function("div", F.col("fraudes") * 200000 + F.col("total"), F.nullif(F.col("total") * 2, F.lit(0)))
    pct = F.coalesce(share.cast("decimal(18,0)") / 1000, F.lit(0)).cast("decimal(9,3)")
    return whole.select("total", "fraudes", pct.alias("pct"), "cartes", "clients", "marchands")


def class_shares(labels: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows and percentage (4 digits) of each class, against the one-row total."""
    counts = labels.groupBy(label).agg(F.count(F.lit(1)).alias("nb"))
    total = labels.agg(F.count(F.lit(1)).alias("_all"))
    return counts.join(total).select(label, "nb", rate_pct(F.col("nb"), F.col("_all")).alias("pct"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(name).alias("nom_table"), "nb_lignes")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb"))
