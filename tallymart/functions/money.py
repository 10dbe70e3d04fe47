"""Money is summed and rounded as decimals and leaves a report as double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def total(c: Column | str) -> Column:
    return F.sum(c).cast("double")


def to_double(c: Column | str, places: int = 2) -> Column:
    """Rounded half away from zero, as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, places).cast("double")


def mean(sum_: Column, count: Column) -> Column:
    """Mean of decimals rounded half away from zero to cents; NULL for no rows.

    Divides once, in whole cents: a quotient of decimals keeps six digits only if the sum is wide, and
    rounding that again can be a cent off.
    """
    n = count.cast("decimal(38,0)")
    cents = (F.abs(sum_) * 100).cast("decimal(38,0)")
    whole = F.call_function("div", cents * 2 + n, n * 2)
    sign = F.when(sum_ < 0, -1.0).otherwise(1.0)
    return F.when(count > 0, sign * whole.cast("double") / 100.0)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to two digits; NULL where whole is 0."""
    scaled = (part * 100).cast("decimal(24,2)")
    return F.round(F.try_divide(scaled, whole.cast("decimal(20,2)")), 2).cast("double")
