"""Data-quality rules in place of database constraints.

A check is a frame ``(rule, table_name, key, n_violations)``; the ``*_violations`` functions
give the offending rows or keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.joins import orphans

COLUMNS = ("rule", "table_name", "key", "n_violations")


def _labelled(count: DataFrame, rule: str, table: str, key: str) -> DataFrame:
    return count.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(key).alias("key"), "n_violations"
    )


def _no_null(keys: Sequence[str]) -> Column:
    result = F.lit(True)
    for k in keys:
        result = result & F.col(k).isNotNull()
    return result


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or contain a NULL, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter((F.col("n_rows") > 1) | ~_no_null(keys))


def primary_key(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    count = primary_key_violations(df, keys).agg(F.count("*").alias("n_violations"))
    return _labelled(count, "primary_key", table, ",".join(keys))


def new_key(table: str, df: DataFrame, keys: Sequence[str], existing: DataFrame) -> DataFrame:
    """Keys of ``df`` that ``existing`` already has. ``df`` is the small side, which Spark may broadcast."""
    taken = existing.select(*keys).join(df.select(*keys).distinct(), list(keys), "left_semi").distinct()
    return _labelled(taken.agg(F.count("*").alias("n_violations")), "new_key", table, ",".join(keys))


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL never collides."""
    return df.filter(_no_null(keys)).groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def unique(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    count = unique_violations(df, keys).agg(F.count("*").alias("n_violations"))
    return _labelled(count, "unique", table, ",".join(keys))


def row_rules(table: str, df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Any number of row conditions in one pass; as with CHECK, an unknown (NULL) result passes."""
    broken = [F.count_if(~F.coalesce(rule, F.lit(True))).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    labelled = [
        F.struct(
            F.lit(name).alias("rule"),
            F.lit(table).alias("table_name"),
            F.lit("").alias("key"),
            F.col(f"_{i}").alias("n_violations"),
        )
        for i, name in enumerate(rules)
    ]
    return df.agg(*broken).select(F.inline(F.array(*labelled)))


def rule_violations(df: DataFrame, rule: Column) -> DataFrame:
    return df.filter(~F.coalesce(rule, F.lit(True)))


def not_null(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return row_rules(table, df, {f"not_null {c}": F.col(c).isNotNull() for c in columns})


def domain(table: str, df: DataFrame, allowed: Mapping[str, Sequence[object]]) -> DataFrame:
    return row_rules(table, df, {f"domain {c}": F.col(c).isin(*values) for c, values in allowed.items()})


def foreign_key_violations(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Missing parent keys with the number of child rows that use them. Rows are counted per key before the join."""
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return orphans(used, parent, key, parent_key)


def foreign_key(table: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    count = foreign_key_violations(child, key, parent, parent_key).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_violations")
    )
    return _labelled(count, "foreign_key", table, key)


def not_before(
    table: str, child: DataFrame, day: str, parent: DataFrame, parent_day: str, key: str
) -> DataFrame:
    """Child rows dated before their parent, such as orders placed before the customer signed up."""
    dated = child.select(key, F.col(day).alias("_day")).join(parent.select(key, F.col(parent_day).alias("_from")), key)
    count = dated.agg(F.count_if(F.col("_day") < F.col("_from")).alias("n_violations"))
    return _labelled(count, f"{day} not before {parent_day}", table, key)


def reconcile(expected: Mapping[str, Column | int], actual: Mapping[str, DataFrame]) -> DataFrame:
    """Expected against actual row count per table."""
    result = None
    for table, df in actual.items():
        wanted = expected[table]
        wanted = F.lit(wanted).cast("long") if isinstance(wanted, int) else wanted
        row = (
            df.agg(F.count("*").alias("actual"))
            .select(F.lit(table).alias("table_name"), wanted.alias("expected"), "actual")
            .withColumn("ok", F.col("expected") == F.col("actual"))
        )
        result = row if result is None else result.unionByName(row)
    return result


def keys_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows, distinct keys, and whether they agree."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"))
        .withColumn("ok", F.col("n_rows") == F.col("n_keys"))
    )


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def report(*checks: DataFrame) -> DataFrame:
    result = checks[0]
    for c in checks[1:]:
        result = result.unionByName(c)
    return result
