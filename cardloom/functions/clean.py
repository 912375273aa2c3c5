"""Conversion of raw text fields. Every cast is a try-cast: a bad field turns
NULL and is left for the quality checks, it does not end the job."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of "yes".
YES_WORDS = ("YES", "Y", "TRUE", "1")

# Field texts that the usual CSV readers take for "missing".
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def text(x: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    t = F.trim(x)
    return F.when(~t.isin(*MISSING_WORDS), t)


def yes_no(x: Column) -> Column:
    """'Y' for any spelling of yes, else 'N', NULL included."""
    return F.when(F.upper(F.trim(x)).isin(*YES_WORDS), "Y").otherwise("N")


def whole(x: Column, to: str = "int") -> Column:
    """Whole number; a fraction part is cut off ("66.0" gives 66)."""
    return F.trim(x).try_cast("decimal(28,8)").try_cast(to)


def number(x: Column, to: str = "double") -> Column:
    return F.trim(x).try_cast(to)


def money(x: Column, empty: str | None = None) -> Column:
    """Amount without '$' and thousands commas, sign kept.

    ``empty`` is the value for an empty text; other unreadable text is NULL.
    """
    bare = F.regexp_replace(F.trim(x), "[$,]", "")
    value = bare.try_cast("decimal(12,2)")
    if empty is not None:
        value = F.when(bare == "", F.lit(empty).cast("decimal(12,2)")).otherwise(value)
    return value


def mixed_date(x: Column) -> Column:
    """``MM/YYYY`` (first of that month) or ISO date."""
    t = F.trim(x)
    padded = F.when(F.instr(t, "/") == 2, F.concat(F.lit("0"), t)).otherwise(t)
    return F.coalesce(
        F.try_to_timestamp(padded, F.lit("MM/yyyy")),
        F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")),
    ).cast("date")


def timestamp(x: Column) -> Column:
    return F.try_to_timestamp(F.trim(x), F.lit("yyyy-MM-dd HH:mm:ss"))


def moment(value: datetime | date) -> Column:
    """Literal of a Python date or time. A time without zone is read in the
    session's zone, not in that of the driver's machine."""
    if isinstance(value, datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp")
    return F.lit(value)
