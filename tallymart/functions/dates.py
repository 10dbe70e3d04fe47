"""Date expressions: month labels, month distance, tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date spellings that occur in the feeds.
DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "M/d/yyyy")
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def month_label(d: Column) -> Column:
    """``yyyy-MM``; sorts in time order."""
    return F.date_format(d, "yyyy-MM")


def month_slice(text: Column) -> Column:
    """``MM-yyyy`` cut out of a ``dd-MM-yyyy`` text; sorts as text, not in time order."""
    return F.substring(text, 4, 7)


def month_number(d: Column) -> Column:
    """Months since year 0, so that a difference is a distance in months."""
    return F.year(d) * 12 + F.month(d)


def tolerant_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that fits, NULL where none does."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])


def tolerant_number(text: Column) -> Column:
    """Double, NULL where the text is no number (or says NaN, or ends in a type letter as in ``10d``)."""
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))
