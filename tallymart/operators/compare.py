"""Which rows of two copies of a table differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = (8, 16)  # bits of the key's hash at each level of the tree


def _sums(df: DataFrame, name: str) -> DataFrame:
    """Rows and an order-free sum of row hashes per node; copies of a row count as often as they occur."""
    return df.groupBy("_node").agg(F.count("*").alias(f"n_{name}"), F.sum(F.col("_row").cast("decimal(38,0)")).alias(f"s_{name}"))


def differing_rows(source: DataFrame, target: DataFrame, key: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """Rows that occur in ``source`` and ``target`` a different number of times: all columns, n_source, n_target.

    Both sides are summed up by nodes, ranges of the hash of ``key``; only rows of nodes that disagree are summed up again by
    smaller ones, and only those of the last level's are compared as rows. Equal copies cost one narrow
    aggregation each, and no more rows are shuffled than nodes that differ hold. Both sides need the same columns.
    """
    columns = source.columns
    sides = []
    for df in (source, target.select(*columns)):
        row = F.xxhash64(*[F.col(c).cast("string") for c in columns], *[F.col(c).isNull() for c in columns])
        sides.append(df.withColumn("_key", F.xxhash64(*key)).withColumn("_row", row))
    for bits in levels:
        at = [df.withColumn("_node", F.shiftrightunsigned("_key", 64 - bits)) for df in sides]
        both = _sums(at[0], "a").join(_sums(at[1], "b"), "_node", "full")
        unequal = both.filter(~(F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("s_a").eqNullSafe(F.col("s_b")))).select("_node")
        sides = [df.join(unequal, "_node", "left_semi") for df in at]  # at most 2 ** bits nodes
        sides = [df.drop("_node") for df in sides]
    counted = [df.groupBy(*columns).agg(F.count("*").alias("_n")) for df in sides]
    zero = F.lit(0).cast("long")
    signed = counted[0].select(*columns, F.col("_n").alias("n_source"), zero.alias("n_target")).unionByName(counted[1].select(*columns, zero.alias("n_source"), F.col("_n").alias("n_target")))
    return signed.groupBy(*columns).agg(F.sum("n_source").alias("n_source"), F.sum("n_target").alias("n_target")).filter("n_source <> n_target")
