"""The seven features and the label, for training and for scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Feature order, types and defaults.
FEATURES = ("amount", "use_chip", "mcc_code", "merchant_state", "hour", "current_age", "gender")
NUMERIC = ("amount", "mcc_code", "hour", "current_age")
CATEGORICAL = ("use_chip", "merchant_state", "gender")
TYPES = {
    "amount": "double", "use_chip": "string", "mcc_code": "int", "merchant_state": "string",
    "hour": "int", "current_age": "double", "gender": "string",
}
DEFAULTS = {
    "amount": 0.0, "use_chip": "Swipe Transaction", "mcc_code": 0, "merchant_state": "UNKNOWN",
    "hour": 12, "current_age": 45.0, "gender": "UNKNOWN",
}


def _typed_field(schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """The column at ``path`` with its type, when the schema has it."""
    node: T.DataType = schema
    for part in path.split("."):
        if not isinstance(node, T.StructType) or part not in node.names:
            return None
        node = node[part].dataType
    return F.col(path), node


def _first(df: DataFrame, *paths: str, read=lambda c, kind: F.nullif(c.cast("string"), F.lit(""))) -> Column:
    """First value among the paths that ``read`` does not give as NULL."""
    found = [read(*f) for f in (_typed_field(df.schema, p) for p in paths) if f is not None]
    return F.coalesce(*found) if found else F.lit(None)


def _number(as_type: str):
    def read(c: Column, kind: T.DataType) -> Column:
        return c.cast(as_type) if isinstance(kind, T.NumericType) else c.cast("string").try_cast(as_type)

    return read


def _or_default(value: Column, name: str) -> Column:
    return F.coalesce(value, F.lit(DEFAULTS[name])).cast(TYPES[name]).alias(name)


def _truthy(value: Column) -> Column:
    """NULL for zero, as zero counts as missing in training documents."""
    return F.nullif(value, F.lit(0).cast("double"))


def hour_of(c: Column, kind: T.DataType) -> Column:
    """Hour of a time or of an ISO text: 0 for a bare date, 12 for other text.

    The hour of a text stands as written; an offset in it does not move it.
    """
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.hour(c)
    text = F.nullif(c.cast("string"), F.lit(""))
    written = F.regexp_extract(text, r"^\d{4}-\d{2}-\d{2}[T ](\d{2})", 1).try_cast("int")
    return F.when(text.try_cast("timestamp").isNotNull(), F.coalesce(written, F.lit(0))).when(
        text.isNotNull(), DEFAULTS["hour"]
    )


def document_features(docs: DataFrame, *keep: str) -> DataFrame:
    """Features of documents with either set of field names, plus columns to keep."""
    return docs.select(
        *keep,
        _or_default(_first(docs, "amount", read=_number("double")), "amount"),
        _or_default(_first(docs, "use_chip"), "use_chip"),
        _or_default(_first(docs, "mcc.code", read=_number("int")), "mcc_code"),
        _or_default(_first(docs, "marchand.etat", "marchand.state"), "merchant_state"),
        _or_default(_first(docs, "date_transaction", "date", read=hour_of), "hour"),
        _or_default(_truthy(_first(docs, "client.current_age", read=_number("double"))), "current_age"),
        _or_default(_first(docs, "client.gender"), "gender"),
    )


def document_label(docs: DataFrame) -> Column:
    """1 fraud, 0 no fraud, NULL when not labelled or not readable."""
    flag = _first(docs, "fraude.labelled", "fraude.is_labellisee", read=lambda c, kind: c.cast("boolean"))
    labelled = F.coalesce(flag, F.lit(False))
    answer = _first(docs, "fraude.is_fraud")
    code = F.when(answer.isin("true", "Yes"), 1).when(answer.isin("false", "No"), 0)
    return F.when(labelled, code).cast("int")


def request_features(requests: DataFrame, *keep: str) -> DataFrame:
    """Features of score requests: hour 0 and age 0 are values, not gaps."""
    rows = ordered(requests, *keep)
    blank = lambda n: F.nullif(F.col(n), F.lit("")) if TYPES[n] == "string" else F.col(n)
    return rows.select(*keep, *[_or_default(blank(n), n) for n in FEATURES])


def ordered(rows: DataFrame, *keep: str) -> DataFrame:
    """Feature columns in their fixed order and type, absent ones NULL."""
    have = set(rows.columns)
    return rows.select(
        *keep, *[(F.col(n) if n in have else F.lit(None)).cast(TYPES[n]).alias(n) for n in FEATURES]
    )


def training_rows(docs: DataFrame) -> DataFrame:
    """id_transaction, features and label of the labelled documents."""
    rows = document_features(docs.withColumn("label", document_label(docs)), "id_transaction", "label")
    return rows.where(F.col("label").isNotNull())
