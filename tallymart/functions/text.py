"""Text expressions used by the cleaners."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing entry after lower-casing.
MISSING_WORDS = ("nan", "none", "")


def strip_space(c: Column) -> Column:
    """Remove leading and trailing white space of any kind; NULL stays NULL."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def text_key(c: Column) -> Column:
    """Comparable form of a text key: stripped and lower-cased."""
    return F.lower(strip_space(c))


def missing_to_null(c: Column, words: Iterable[str] = MISSING_WORDS) -> Column:
    return F.when(~c.isin(*words), c)


def same_ignoring_case(c: Column, text: str) -> Column:
    """Comparison as databases with a case-insensitive default collation make it."""
    return F.collate(c, "UTF8_LCASE") == F.lit(text)


def is_blank(c: Column) -> Column:
    return F.trim(c) == ""


def standard_name(name: str) -> str:
    """Column name that any table format accepts: blank, hyphen and slash become underscores."""
    return name.translate(str.maketrans(" -/", "___"))
