"""Cleaning steps: nulls, duplicates, types, integrity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.text import is_blank, standard_name
from tallymart.operators import ranking


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """NULLs become the median, in the column's own type: rounded where that has fewer digits."""
    filler = ranking.median(df, column).scalar().cast(df.schema[column].dataType)
    return df.withColumn(column, F.coalesce(F.col(column), filler))


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    filler = ranking.mode(df, column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), filler))


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, which one is left open. Use ``keep_first`` where it matters."""
    return df.dropDuplicates(list(keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order.

    Spark limits each group to one row before the shuffle, so a key with very many
    copies sends one row per input split.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking.sort_keys(order)))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def keep_positive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with values above zero in all given columns; a NULL drops too."""
    for c in columns:
        df = df.filter(F.col(c) > 0)
    return df


def keep_until(df: DataFrame, column: str, last_day: date) -> DataFrame:
    """Rows up to ``last_day``; a NULL date drops too."""
    return df.filter(F.col(column) <= F.lit(last_day))


def keep_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*allowed))


def keep_known(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``parent``, whose keys shrink to one row each first."""
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return df.join(known, key, "left_semi")


def keep_parents_with_children(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parents that still have at least one child row; child keys shrink to one row each first."""
    return parent.join(child.select(key).distinct(), key, "left_semi")


def keep_reachable(df: DataFrame, email: str = "email", username: str = "username") -> DataFrame:
    """Rows with an email and a user name that is not blank; a NULL user name drops too."""
    return df.filter(F.col(email).isNotNull() & ~is_blank(F.col(username)))


def standardise_names(df: DataFrame) -> DataFrame:
    names = [standard_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide after standardising: {names}")
    return df.toDF(*names)


def parse_timestamp(df: DataFrame, source: str, target: str) -> DataFrame:
    """Replace a text column by a timestamp column; bad text becomes NULL."""
    return df.withColumn(target, F.col(source).try_cast("timestamp_ntz")).drop(source)
