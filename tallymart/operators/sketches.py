"""Distinct counts and quantiles of several columns at once: exact without repeating rows, and as stored sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import scans
from tallymart.session import few_rows, materialise

LG_K = 12  # 4,096 registers of a distinct sketch


def relative_error(lg_k: int = LG_K, deviations: int = 4) -> float:
    """Bound of a united sketch's relative error: so many times its standard error of 1.04 / sqrt(2^lg_k)."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def distinct_counts(df: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """``{out: column}``: COUNT(DISTINCT column) per group, NULLs not counted.

    Every column's values are made distinct on their own, before and after one shuffle of (group, value), so no row is
    repeated per column as with several distinct aggregates in one step; a hot group is spread by its values.
    """
    result = None
    for out, c in columns.items():
        counted = df.select(*by, F.col(c).alias("_value")).distinct().groupBy(*by).agg(F.count("_value").alias("_n"))
        counted = counted.select(*by, *[(F.col("_n") if name == out else F.lit(0).cast("long")).alias(name) for name in columns])
        result = counted if result is None else result.unionByName(counted)
    return result.groupBy(*by).agg(*[F.sum(out).alias(out) for out in columns])


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Mapping[str, str], lg_k: int = LG_K) -> DataFrame:
    """Per group a sketch of each column's distinct values, to be stored and united later; a few kilobytes each."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c, lg_k).alias(out) for out, c in columns.items()])


def united_distinct_counts(sketches: DataFrame, by: Sequence[str], outs: Sequence[str]) -> DataFrame:
    """Estimated distinct counts of coarser groups from ``distinct_sketches``; see ``relative_error``."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(out)).alias(out) for out in outs])


def quantiles(df: DataFrame, columns: Sequence[str], at: Sequence[float] = (0.25, 0.5, 0.75), accuracy: int = 1000) -> DataFrame:
    """Exact quantiles (the value at place ceil(q * n)): column_name, n, and per q a column ``q<percent>`` as double.

    Two passes for any number of columns. The first builds a mergeable quantile sketch per column, whose places are wrong by at
    most n / accuracy, and takes values safely below and above each quantile. The second counts what lies below and
    the values in between, about 4 / accuracy of the rows, whose running count over ranges leads to the place.
    NULLs are left out; a column without values has NULLs.
    """
    margin = 2 / accuracy
    edges = [max(0.0, q - margin) for q in at] + [min(1.0, q + margin) for q in at]
    first = df.agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(F.col(c).cast("double"), edges, accuracy).alias("edges")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    names = {q: f"q{round(100 * q):02d}" for q in at}
    parts, places = [], []
    for i, c in enumerate(columns):
        for j, q in enumerate(at):
            if not first[i]["n"]:
                continue
            low, high = first[i]["edges"][j], first[i]["edges"][len(at) + j]
            value = F.col(c).cast("double")
            # what lies below counts as NULL, which sorts first
            parts.append(F.struct(F.lit(c).alias("column_name"), F.lit(names[q]).alias("q"), F.when(value >= low, value).alias("value"), (value <= high).alias("near")))
            n = first[i]["n"]
            places.append((c, names[q], int(max(1, n - (n - q * n) // 1))))
    spark = df.sparkSession
    counts = few_rows(spark, [(c, first[i]["n"]) for i, c in enumerate(columns)], "column_name string, n long")
    if not parts:
        return counts.select("*", *[F.lit(None).cast("double").alias(x) for x in names.values()])
    near = df.select(F.inline(F.array(*parts))).filter("near").groupBy("column_name", "q", "value").agg(F.count("*").alias("c"))
    walked = scans.scan(materialise(near, "near-quantiles"), ["value"], ["column_name", "q"], running={"upto": "c"})
    wanted = few_rows(spark, places, "column_name string, q string, place long")
    found = walked.join(F.broadcast(wanted), ["column_name", "q"]).filter((F.col("upto") >= F.col("place")) & (F.col("upto") - F.col("c") < F.col("place")))
    values = found.groupBy("column_name").agg(*[F.max(F.when(F.col("q") == x, F.col("value"))).alias(x) for x in names.values()])
    return counts.join(values, "column_name", "left")
