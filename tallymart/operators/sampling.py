"""Samples of an exact size that do not depend on how a table is laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS, BUCKET_BITS = 60, 16


def keyed_hash(key: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of ``seed:key``, as a long."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_sample(df: DataFrame, key: Sequence[str], fraction: float, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Of every stratum of ``by`` the ceil(fraction * rows) rows with the smallest keyed hashes, ``key`` breaking ties.

    ``key`` has to be unique. A histogram of hashes per stratum gives the bucket in which the sample ends; rows of
    earlier buckets are in, and only those of that bucket are sorted, 1 in 65,536 of a stratum. ``df`` is read twice.
    """
    hashed = df.withColumn("_hash", keyed_hash(key, seed)).withColumn("_bucket", F.shiftright("_hash", HASH_BITS - BUCKET_BITS))
    strata = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    names = [f"_by{i}" for i in range(len(by))]
    counts = hashed.groupBy(*strata, "_bucket").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*names) if by else Window.partitionBy(F.lit(1))
    # over the buckets of a stratum: 65,536 rows at most
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("*", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.ceil(F.sum("_n").over(whole) * F.lit(fraction).cast("decimal(18,9)")).alias("_size"))
    ends = counts.filter((F.col("_before") < F.col("_size")) & (F.col("_before") + F.col("_n") >= F.col("_size")))
    ends = ends.select(*names, F.col("_bucket").alias("_end"), (F.col("_size") - F.col("_before")).alias("_rest"))
    same = F.lit(True)
    for c, name in zip(by, names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(name))
    if by:
        reached = hashed.join(ends, same)
    else:
        reached = hashed.withColumns({c: ends.select(c).scalar() for c in ("_end", "_rest")})
    sure = reached.filter("_bucket < _end").select(*df.columns)
    last = Window.partitionBy(*by).orderBy("_hash", *key) if by else Window.orderBy("_hash", *key)
    edge = reached.filter("_bucket = _end").withColumn("_place", F.row_number().over(last)).filter("_place <= _rest").select(*df.columns)
    return sure.unionByName(edge)
