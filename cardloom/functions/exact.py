"""Exact half-up rounding of averages and rates.

``avg`` over decimals rounds once at 6 digits and ``round`` a second time, and
division of doubles misses ties. Here the quotient is rounded once, away from
zero on ties, with whole-number arithmetic only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(22,2)"


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_up_mean(total: Column, count: Column) -> Column:
    """``total / count`` to cents; NULL for an empty or all-NULL group."""
    cents = (F.abs(total) * 100).cast("decimal(30,0)")
    n = count.cast("decimal(20,0)")
    q = _div(cents * 2 + n, F.nullif(n * 2, F.lit(0)))
    signed = F.when(total < 0, -q).otherwise(q)
    return (signed.cast("decimal(18,0)") / 100).cast("decimal(18,2)")


def rate_pct(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to 4 decimals; NULL for an empty group."""
    q = _div(part * 2000000 + whole, F.nullif(whole * 2, F.lit(0)))
    return (q.cast("decimal(18,0)") / 10000).cast("decimal(9,4)")
