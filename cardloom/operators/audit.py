"""Change log from two snapshots of a table.

A snapshot pair does not show an update that changes nothing, nor steps between
the two snapshots. Acting user and time are parameters of the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_OPTIONS = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Watch:
    """What is logged for one table: columns per operation, never a secret one."""

    table: str
    key: str
    on_insert: tuple[str, ...]
    on_update: tuple[str, ...]
    on_delete: tuple[str, ...]


CLIENT = Watch(
    "CLIENT", "id_client",
    ("id_client", "current_age", "credit_score"),
    ("current_age", "credit_score"),
    ("id_client", "current_age"),
)
CARTE = Watch(
    "CARTE", "id_carte",
    ("id_carte", "id_client", "card_brand", "credit_limit"),
    ("credit_limit", "card_on_dark_web"),
    ("id_carte", "id_client"),
)
UTILISATEUR_SI = Watch(
    "UTILISATEUR_SI", "id_utilisateur", ("login", "role"), ("role", "actif"), ("login",)
)


def _paired(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    side = lambda df, name: df.select(F.col(key).alias("_key"), F.struct(*df.columns).alias(name))
    return side(before, "old").join(side(after, "new"), "_key", "full")


def _changed() -> Column:
    return ~F.col("old").eqNullSafe(F.col("new"))


def _json(side: str, columns: tuple[str, ...]) -> Column:
    return F.to_json(F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns]), JSON_OPTIONS)


def changes(before: DataFrame, after: DataFrame, watch: Watch) -> DataFrame:
    """Change rows between two snapshots. Any column counts as a change; only the
    watched columns are written."""
    # equal column order on both sides, so that whole rows can be compared
    rows = _paired(before, after.select(*before.columns), watch.key).where(_changed())
    operation = (
        F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")
    )
    return rows.select(
        F.lit(watch.table).alias("table_concernee"),
        F.col("_key").cast("bigint").alias("id_ligne_concernee"),
        operation.alias("operation"),
        F.when(operation == "DELETE", _json("old", watch.on_delete))
        .when(operation == "UPDATE", _json("old", watch.on_update))
        .alias("valeur_avant"),
        F.when(operation == "INSERT", _json("new", watch.on_insert))
        .when(operation == "UPDATE", _json("new", watch.on_update))
        .alias("valeur_apres"),
    )


def stamped(rows: DataFrame, user_id: Column, at: Column, ip: Column | None = None) -> DataFrame:
    """Change rows as rows of the journal. The key is a 64-bit hash of what identifies
    the change, so a repeated job writes the same keys. (Among a billion changes
    two share a key with a chance of about one in twenty; table, row, operation
    and time together are always unique.)"""
    return rows.select(
        F.xxhash64("table_concernee", "id_ligne_concernee", "operation", at).bitwiseAND(F.lit((1 << 63) - 1)).alias("id_audit"),
        user_id.cast("int").alias("id_utilisateur"),
        "table_concernee",
        "id_ligne_concernee",
        "operation",
        "valeur_avant",
        "valeur_apres",
        at.alias("date_operation"),
        (F.lit(None).cast("string") if ip is None else ip).alias("adresse_ip"),
    )


def merged(before: DataFrame, after: DataFrame, key: str, as_of: Column) -> DataFrame:
    """The new snapshot with ``date_modification`` = ``as_of`` on updated rows."""
    old_date = (
        F.col("old.date_modification") if "date_modification" in before.columns else F.lit(None).cast("timestamp")
    )
    columns = [c for c in before.columns if c != "date_modification"]
    rows = _paired(before.select(*before.columns), after.select(*columns), key).where(F.col("new").isNotNull())
    old_row = F.struct(*[F.col(f"old.{c}").alias(c) for c in columns])
    updated = F.col("old").isNotNull() & ~old_row.eqNullSafe(F.col("new"))
    return rows.select("new.*", F.when(updated, as_of).otherwise(old_date).alias("date_modification"))


def history_of(journal: DataFrame, table: str, row_id: int) -> DataFrame:
    """Journal of one row, newest first."""
    return journal.where(
        (F.col("table_concernee") == table) & (F.col("id_ligne_concernee") == row_id)
    ).orderBy(F.desc("date_operation"), F.desc("id_audit"))
