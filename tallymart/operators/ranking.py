"""Ranks, row numbers, n-tiles and medians over a whole table without a one-task window.

``rank() over (order by x)`` moves every row into one task. The functions here sort by
range partitions instead, store the sorted narrow frame once, and add per-partition
offsets, of which there are as many as partitions. Equal values are collapsed to one row
with a count before the sort, or split by a tie-break key, so that a value held by a large
share of the rows does not end up in one task.

An order is a list of column names; a leading ``-`` means descending.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators.scans import at_or_after, column_of, rank, scan, sort_keys  # noqa: F401  (rank is part of this module)
from tallymart.session import materialise, together

_POSITION_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row position in the low 33 bits


def _offsets(counted: DataFrame, *amounts: str) -> DataFrame:
    """Running totals over earlier range partitions; one row per partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    return counted.select(
        "_part",
        *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"_before{a}") for a in amounts],
        *[F.sum(a).over(everything).alias(f"_all{a}") for a in amounts],
    )


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with its 1-based global position ``_rn`` and the row count ``_all_n``.

    ``order`` has to be total (end in a unique key) for a repeatable result.
    """
    keys = sort_keys(order)
    stored = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))),
        "positions",
    )
    offsets = _offsets(stored.groupBy("_part").agg(F.count("*").alias("_n")), "_n")
    return (
        stored.join(F.broadcast(offsets), "_part")  # one row per range partition
        .withColumn("_rn", F.col("_before_n") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before_n")
    )


def row_number(df: DataFrame, order: Sequence[str], out: str = "row_num") -> DataFrame:
    return positions(df, order).drop("_all_n").withColumnRenamed("_rn", out)


def top_ranked(df: DataFrame, k: int, order: Sequence[str], out: str = "rank") -> DataFrame:
    """Rows with RANK <= k, ties kept.

    At most k distinct values can have such a rank, and only those are ranked; ``df`` is read twice. Spark's top-k
    leaves them sorted in one partition, so the running count over them moves nothing. The join has no broadcast
    hint, as k is the caller's.
    """
    cols = [column_of(t) for t in order]
    earlier = Window.orderBy(*sort_keys(order)).rowsBetween(Window.unboundedPreceding, -1)
    leaders = (
        df.groupBy(*cols)
        .agg(F.count("*").alias("_n"))
        .orderBy(*sort_keys(order))
        .limit(k)
        .withColumn("_rank", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1)
        .filter(F.col("_rank") <= k)
        .select(*[F.col(c).alias(f"_key_{c}") for c in cols], "_rank")
    )
    same = F.lit(True)
    for c in cols:
        same = same & df[c].eqNullSafe(leaders[f"_key_{c}"])
    return df.join(leaders, same).select(*[df[c] for c in df.columns], F.col("_rank").alias(out))


def _bucket_starts(df: DataFrame, n: int, order: Sequence[str]) -> list[Row]:
    """The first row of each NTILE(n) bucket but the first one: at most n - 1 rows."""
    base = F.floor(F.col("_all_n") / n)
    extra = F.col("_all_n") % n
    starts = [F.lit(k) * base + F.least(F.lit(k), extra) + 1 for k in range(1, n)]
    sorted_rows = positions(df.select(*[column_of(t) for t in order]), order)
    return sorted_rows.filter(F.col("_rn").isin(*starts)).collect()


def ntiles(df: DataFrame, buckets: Mapping[str, tuple[int, Sequence[str]]]) -> DataFrame:
    """NTILE(n) columns ``{out: (n, order)}``: only the rows that open a bucket are looked up.

    ``df`` itself is not moved, but read once more per column; pass a stored frame where it is costly.
    """
    lookups = [lambda n=n, order=order: _bucket_starts(df, n, order) for n, order in buckets.values()]
    for (out, (_, order)), cuts in zip(buckets.items(), together(*lookups), strict=True):
        bucket = F.lit(1).cast("long")
        for cut in cuts:
            bucket = bucket + F.when(at_or_after(order, cut), 1).otherwise(0)
        df = df.withColumn(out, bucket)
    return df


def ntile(df: DataFrame, n: int, order: Sequence[str], out: str) -> DataFrame:
    return ntiles(df, {out: (n, order)})


def row_number_by(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "row_num") -> DataFrame:
    """ROW_NUMBER within groups of any size. ``order`` has to be total within a group for a repeatable result."""
    return scan(df, order, by, number=out)


def median(df: DataFrame, column: str) -> DataFrame:
    """Exact median of the non-null values as a one-row frame ``median`` (double)."""
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    stored = materialise(values.repartitionByRange("_v").withColumn("_part", F.spark_partition_id()), "median")
    parts = stored.groupBy("_part").agg(F.sum("_n").alias("_n"))
    offsets = _offsets(parts, "_n")
    lower = F.floor((F.col("_all_n") + 1) / 2)
    upper = F.floor((F.col("_all_n") + 2) / 2)
    middle = (
        offsets.join(parts, "_part")
        .filter((F.col("_before_n") < upper) & (F.col("_before_n") + F.col("_n") >= lower))
        .drop("_n")
    )  # the one or two range partitions that hold the middle rows
    up_to = F.col("_before_n") + F.sum("_n").over(Window.partitionBy("_part").orderBy("_v"))
    walked = stored.join(F.broadcast(middle), "_part").withColumn("_to", up_to)
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    value = F.col("_v").cast("decimal(20,0)") if whole else F.col("_v")  # the sum of two has to fit

    def value_at(place: Column) -> Column:
        return F.min(F.when((F.col("_to") >= place) & (F.col("_to") - F.col("_n") < place), value))

    return walked.agg(((value_at(lower) + value_at(upper)).cast("double") / 2).alias("median"))


def mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value, the smallest on ties, as a one-row frame ``mode``."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("mode"))
        .agg(F.count("*").alias("_n"))
        .orderBy(F.col("_n").desc(), F.col("mode").asc())
        .limit(1)
        .select("mode")
    )


def bucket_of(position: Column, rows: Column, n: int) -> Column:
    """NTILE(n) bucket of a 1-based position among ``rows``; the first buckets take the surplus rows."""
    base = F.floor(rows / n)
    extra = rows % n
    wide = extra * (base + 1)
    return (
        F.when(position <= wide, F.ceil(position / (base + 1)))
        .otherwise(extra + F.ceil(F.try_divide(position - wide, base)))
        .cast("long")
    )
