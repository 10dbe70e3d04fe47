"""Profiling: counts, nulls, duplicates, schema and summary, each in one pass over the data."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators import ranking


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*ranking.sort_keys(order)).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last n rows of the order, as a sort in the opposite direction."""
    flipped = [t[1:] if t.startswith("-") else f"-{t}" for t in order]
    return df.orderBy(*ranking.sort_keys(flipped)).limit(n)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def info(df: DataFrame) -> DataFrame:
    """Position, name, type, nullability and number of filled entries of each column."""
    filled = df.agg(*[F.count(c).alias(f"_{i}") for i, c in enumerate(df.columns, 1)])
    described = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f"_{i}").alias("non_nulls"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return filled.select(F.inline(F.array(*described)))


def plan_text(df: DataFrame) -> str:
    """The physical plan as text, its numbered steps with their details and then a line for each; each ``Exchange`` in it is a shuffle."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
        df.explain("simple")
    return out.getvalue()


class PlanSummary(NamedTuple):
    """What a plan costs at scale: its shuffles, broadcasts and scans, the columns the scans read and the filters they take."""

    shuffles: int
    broadcasts: int
    scans: int
    columns_read: list[str]
    pushed: list[str]


def plan_summary(df: DataFrame) -> PlanSummary:
    """The plan of ``df`` as Spark explains it before it runs; nothing is read."""
    shuffles = broadcasts = scans = 0
    columns, pushed = set(), set()
    for line in plan_text(df).splitlines():
        if step := re.match(r"\(\d+\) (\S+)", line):
            shuffles += step[1] == "Exchange"
            broadcasts += step[1] == "BroadcastExchange"
            scans += step[1] == "Scan"
        elif line.startswith("ReadSchema: struct<"):
            columns |= set(re.findall(r"(?:^|,)([^:,<>]+):", line[len("ReadSchema: struct<") : -1]))
        elif line.startswith("PushedFilters: ["):
            pushed |= set(re.findall(r"\w+\([^()]*(?:\([^()]*\)[^()]*)*\)", line))
    return PlanSummary(shuffles, broadcasts, scans, sorted(columns), sorted(pushed))


def _unpivot(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    return one_row.unpivot([], list(columns), "column_name", value)


def null_counts(df: DataFrame, only_present: bool = False) -> DataFrame:
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    counts = _unpivot(one_row, df.columns, "nulls")
    return counts.filter("nulls > 0") if only_present else counts


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("nulls").alias("total_nulls"))


def rows_with_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.filter(missing)


def null_blank_audit(df: DataFrame) -> DataFrame:
    """Nulls per column and blank texts per string column; columns with neither are left out."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    one_row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{i}_nulls") for i, c in enumerate(df.columns)],
        *[
            (F.count_if(F.trim(F.col(c)) == "") if c in texts else F.lit(0).cast("long")).alias(f"{i}_blanks")
            for i, c in enumerate(df.columns)
        ],
    )
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"{i}_nulls").alias("nulls"), F.col(f"{i}_blanks").alias("blanks")
        )
        for i, c in enumerate(df.columns)
    ]
    return one_row.select(F.inline(F.array(*per_column))).filter("nulls > 0 or blanks > 0")


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the surplus. Copies are counted before the shuffle."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct"))
        .withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "duplicate_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out)).filter(F.col(out) > 1)


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per numeric column."""
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return one_row.select(F.inline(F.array(*[F.col(c) for c in columns])))


def step_audit(steps: Sequence[tuple[str, str, DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after each (table, step, before, after). Pass stored frames: the count is then a footer read."""
    result = None
    for table, step, before, after in steps:
        counted = (
            before.agg(F.count("*").alias("rows_before"))
            .select(
                F.lit(table).alias("table_name"),
                F.lit(step).alias("step"),
                "rows_before",
                after.agg(F.count("*")).scalar().alias("rows_after"),
            )
            .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
        )
        result = counted if result is None else result.unionByName(counted)
    return result


def sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(False, fraction, seed)
