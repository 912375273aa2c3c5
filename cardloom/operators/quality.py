"""Table rules, orphan checks, retention, contract validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.operators.derive import repeated_keys
from cardloom.schemas import GENDERS, OPERATIONS, ROLES, SECRET_COLUMNS, USE_CHIP_VALUES
from cardloom.session import scratch_path

RETENTION_DAYS = 730


def _c(name: str) -> Column:
    return F.col(name)


def _null_or(name: str, rule: Column) -> Column:
    return _c(name).isNull() | rule


def _required(*names: str) -> dict[str, Column]:
    return {f"{n} not null": _c(n).isNotNull() for n in names}


# Table rules as predicates that hold for a good row. The bounds are fixed values.
RULES: dict[str, dict[str, Column]] = {}


def rules_for(table: str) -> dict[str, Column]:
    """Rules of one table (built on first use: columns need a session)."""
    if not RULES:
        RULES.update(_all_rules())
    return RULES[table]


def _all_rules() -> dict[str, dict[str, Column]]:
    yn = ("Y", "N")
    return {
        "mcc": {**_required("code_mcc", "libelle_mcc"), "code 0..9999": _c("code_mcc").between(0, 9999)},
        "utilisateur_si": {
            **_required("id_utilisateur", "login", "nom_complet", "email", "role", "actif"),
            "role known": _c("role").isin(*ROLES),
            "actif Y/N": _c("actif").isin(*yn),
        },
        "client": {
            **_required("id_client", "num_credit_cards", "current_age", "birth_year"),
            "current_age 1..129": _c("current_age").between(1, 129),
            "retirement_age 1..129": _null_or("retirement_age", _c("retirement_age").between(1, 129)),
            "birth_year from 1900": _c("birth_year") >= 1900,
            "birth_month 1..12": _null_or("birth_month", _c("birth_month").between(1, 12)),
            "gender known": _null_or("gender", _c("gender").isin(*GENDERS)),
            "latitude -90..90": _null_or("latitude", _c("latitude").between(-90, 90)),
            "longitude -180..180": _null_or("longitude", _c("longitude").between(-180, 180)),
            "credit_score 300..850": _null_or("credit_score", _c("credit_score").between(300, 850)),
            "num_credit_cards from 0": _c("num_credit_cards") >= 0,
        },
        "marchand": _required("id_marchand", "code_mcc"),
        "carte": {
            **_required(
                "id_carte", "id_client", "card_brand", "card_type", "expires", "acct_open_date", "has_chip",
                "card_on_dark_web", "card_number_enc", "cvv_enc",
            ),
            "has_chip Y/N": _c("has_chip").isin(*yn),
            "card_on_dark_web Y/N": _c("card_on_dark_web").isin(*yn),
            "credit_limit from 0": _null_or("credit_limit", _c("credit_limit") >= 0),
            "num_cards_issued from 0": _null_or("num_cards_issued", _c("num_cards_issued") >= 0),
            "year_pin from 1900": _null_or("year_pin_last_changed", _c("year_pin_last_changed") >= 1900),
        },
        "transaction": {
            **_required(
                "id_transaction", "id_carte", "id_marchand", "date_transaction", "amount", "situation_date"
            ),
            "use_chip known": _null_or("use_chip", _c("use_chip").isin(*USE_CHIP_VALUES)),
        },
        "label_fraude": {**_required("id_transaction", "is_fraud"), "is_fraud Y/N": _c("is_fraud").isin(*yn)},
        "erreur_transaction": _required("id_erreur", "id_transaction", "code_erreur"),
        "journal_audit": {
            **_required("id_audit", "id_utilisateur", "table_concernee", "id_ligne_concernee", "operation"),
            "operation known": _c("operation").isin(*OPERATIONS),
        },
    }


def check_rules(df: DataFrame, table: str) -> DataFrame:
    """(table, regle, violations, lignes), all rules counted in one pass.

    A rule that is NULL for a row counts as a violation for a required column
    only; ``count_if(not rule)`` leaves NULL out, as a CHECK does. The rules of
    encrypted columns are left out where a table is kept without them.
    """
    without = [f"{c} not null" for c in SECRET_COLUMNS if c not in df.columns]
    rules = {name: rule for name, rule in rules_for(table).items() if name not in without}
    counted = df.agg(
        F.count(F.lit(1)).alias("lignes"),
        *[F.count_if(~rule).alias(f"r{i}") for i, rule in enumerate(rules.values())],
    )
    pairs = F.array(
        *[F.struct(F.lit(name).alias("regle"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)]
    )
    return counted.select(F.lit(table).alias("nom_table"), F.explode(pairs).alias("p"), "lignes").select(
        "nom_table", "p.regle", "p.violations", "lignes"
    )


# child table, child key, parent table, parent key
FOREIGN_KEYS = (
    ("carte", "id_client", "client", "id_client"),
    ("marchand", "code_mcc", "mcc", "code_mcc"),
    ("transaction", "id_carte", "carte", "id_carte"),
    ("transaction", "id_marchand", "marchand", "id_marchand"),
    ("label_fraude", "id_transaction", "transaction", "id_transaction"),
    ("erreur_transaction", "id_transaction", "transaction", "id_transaction"),
    ("journal_audit", "id_utilisateur", "utilisateur_si", "id_utilisateur"),
)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without parent, with their number of rows.

    Child rows are counted per key before the anti join: a key held by many rows
    meets the join once.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("nb"))
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return keys.join(parents, F.col(child_key) == F.col("_parent"), "left_anti")


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(nom_table, cle, orphelins) for every foreign key whose tables are given."""
    parts = [
        orphans(tables[child], key, tables[parent], parent_key)
        .agg(F.coalesce(F.sum("nb"), F.lit(0)).alias("orphelins"))
        .select(F.lit(child).alias("nom_table"), F.lit(key).alias("cle"), "orphelins")
        for child, key, parent, parent_key in FOREIGN_KEYS
        if child in tables and parent in tables
    ]
    if not parts:
        some = next(iter(tables.values()))
        return some.limit(0).select(F.lit("").alias("nom_table"), F.lit("").alias("cle"), F.lit(0).cast("bigint").alias("orphelins"))
    return reduce(DataFrame.unionByName, parts)


PRIMARY_KEYS = {
    "mcc": "code_mcc",
    "utilisateur_si": "id_utilisateur",
    "client": "id_client",
    "marchand": "id_marchand",
    "carte": "id_carte",
    "transaction": "id_transaction",
    "label_fraude": "id_transaction",
    "erreur_transaction": "id_erreur",
    "journal_audit": "id_audit",
}
# Columns besides the primary key that may not repeat.
UNIQUE_COLUMNS = {"utilisateur_si": ("login", "email")}


def uniqueness_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(nom_table, cle, doublons): rows beyond the first per primary key and per other unique column."""
    parts = [
        repeated_keys(df.where(F.col(key).isNotNull()) if key != PRIMARY_KEYS[name] else df, key)
        .agg(F.coalesce(F.sum(F.col("nb") - 1), F.lit(0)).alias("doublons"))
        .select(F.lit(name).alias("nom_table"), F.lit(key).alias("cle"), "doublons")
        for name, df in tables.items()
        for key in (PRIMARY_KEYS[name], *UNIQUE_COLUMNS.get(name, ()))
    ]
    return reduce(DataFrame.unionByName, parts)


def suite(tables: dict[str, DataFrame]) -> DataFrame:
    """Whole quality report: (famille, nom_table, regle, violations).

    Each table is read once. A row gives one item per key it holds and one per
    rule it breaks; items are counted per (check, value) within the map tasks
    first, so a rule that all rows break or a parent that holds a third of the
    children shuffles one item per task. From the stored counts follow the broken
    rules, the repeated keys and, by one anti join of all foreign keys with all
    primary keys, the orphans.
    """
    rules, uniques, foreign = _checks(tables)
    checks = [*rules, *uniques, *foreign]
    number = {check: i for i, check in enumerate(checks)}
    items = []
    for name, df in tables.items():
        given = [
            _item(F.lit(number[check]), when=~rules_for(name)[check[2]]) for check in rules if check[1] == name
        ] + [
            # the primary key counts where it is missing, too; other columns only where they are given
            _item(F.lit(number[check]), check[2], df, when=None if check[2] == PRIMARY_KEYS[name] else _c(check[2]).isNotNull())
            for check in uniques if check[1] == name
        ] + [_item(F.lit(number[check]), check[2], df, when=_c(check[2]).isNotNull()) for check in foreign if check[1] == name]
        items.append(df.select(F.inline(F.filter(F.array(*given), lambda x: x.isNotNull()))))
    counts = reduce(DataFrame.unionByName, items).groupBy("numero", "cle", "texte").agg(F.count(F.lit(1)).alias("nb"))
    path = scratch_path(counts.sparkSession, "quality-counts")
    counts.write.parquet(path)
    counts = counts.sparkSession.read.schema(counts.schema).parquet(path)

    first_unique, first_foreign = len(rules), len(rules) + len(uniques)
    of_unique = F.col("numero").between(first_unique, first_foreign - 1)
    totals = counts.where(F.col("numero") < first_foreign).groupBy("numero").agg(F.sum(F.col("nb") - of_unique.cast("int")).alias("violations"))
    if foreign:
        parents = {number[check]: number["doublon", parent, key] for check, (parent, key) in foreign.items()}
        parent_of = F.element_at(F.create_map(*[F.lit(n) for pair in parents.items() for n in pair]), F.col("numero"))
        children = counts.where(F.col("numero") >= first_foreign).withColumn("parent", parent_of)
        keys = counts.where(of_unique & F.col("cle").isNotNull()).select(F.col("numero").alias("parent"), "cle")
        lost = children.join(keys, ["parent", "cle"], "left_anti")
        totals = totals.unionByName(lost.groupBy("numero").agg(F.sum("nb").alias("violations")))
    names = F.array(*[F.struct(F.lit(i).alias("numero"), *[F.lit(v).alias(c) for c, v in zip(("famille", "nom_table", "regle"), check)]) for check, i in number.items()])
    every = counts.sparkSession.range(1).select(F.inline(names))
    return every.join(totals, "numero", "left").select("famille", "nom_table", "regle", F.coalesce("violations", F.lit(0)).alias("violations"))


def _checks(tables: dict[str, DataFrame]) -> tuple[list[tuple], list[tuple], dict[tuple, tuple[str, str]]]:
    """Checks (family, table, rule or column) of the given tables: rules, unique columns, and foreign keys with their parents."""
    rules, uniques = [], []
    for name, df in tables.items():
        without = [f"{c} not null" for c in SECRET_COLUMNS if c not in df.columns]
        rules += [("regle", name, rule) for rule in rules_for(name) if rule not in without]
        uniques += [("doublon", name, key) for key in (PRIMARY_KEYS[name], *UNIQUE_COLUMNS.get(name, ()))]
    foreign = {
        ("orphelin", child, key): (parent, parent_key)
        for child, key, parent, parent_key in FOREIGN_KEYS if child in tables and parent in tables
    }
    return rules, uniques, foreign


def _item(number: Column, column: str | None = None, df: DataFrame | None = None, when: Column | None = None) -> Column:
    """(check, value) of a row, or null where ``when`` does not hold. Whole numbers and texts stand in columns of their own."""
    is_text = column is not None and dict(df.dtypes)[column] == "string"
    none = F.lit(None)
    item = F.struct(
        number.alias("numero"),
        (none if column is None or is_text else _c(column)).cast("bigint").alias("cle"),
        (_c(column) if is_text else none).cast("string").alias("texte"),
    )
    return item if when is None else F.when(when, item)


def retained(df: DataFrame, now: Column, ingested: str = "_ingested_at") -> DataFrame:
    """Rows not older than 730 days since their ingestion."""
    return df.where(F.col(ingested) >= now - F.expr(f"interval {RETENTION_DAYS} days"))


def request_rules() -> dict[str, Column]:
    """Contract of a score request: predicates that hold for a valid one."""
    return {
        # NaN is above every number in Spark's order, and no amount
        "amount": F.coalesce((_c("amount") > 0) & ~F.isnan("amount"), F.lit(False)),
        "use_chip": _null_or("use_chip", _c("use_chip").isin(*USE_CHIP_VALUES)),
        "mcc_code": _null_or("mcc_code", _c("mcc_code") >= 0),
        "merchant_state": _null_or("merchant_state", F.length("merchant_state") <= 10),
        "hour": _null_or("hour", _c("hour").between(0, 23)),
        "current_age": _null_or("current_age", (_c("current_age") > 0) & (_c("current_age") < 120)),
        "gender": _null_or("gender", _c("gender").isin("Male", "Female")),
    }


def validated(requests: DataFrame) -> DataFrame:
    """Requests with ``erreurs``: the fields that break the contract, '' when valid."""
    broken = [F.when(~rule, field) for field, rule in request_rules().items()]
    return requests.withColumn("erreurs", F.concat_ws(",", *broken))


def valid_requests(requests: DataFrame) -> DataFrame:
    return requests.where(reduce(lambda a, b: a & b, request_rules().values()))


def quarantined(requests: DataFrame) -> DataFrame:
    return validated(requests).where(F.col("erreurs") != "")
