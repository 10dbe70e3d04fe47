"""A flat order book: renaming, tax, filters, export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.sources import readers, writers

TAX_FACTOR = 1.18  # fixed value: price with 18 % tax


def typed(df: DataFrame) -> DataFrame:
    """``product_name`` becomes ``item_name``, the text ``price`` becomes a number."""
    return df.withColumnRenamed("product_name", "item_name").withColumn("price", F.col("price").try_cast("double"))


def with_tax(df: DataFrame) -> DataFrame:
    return df.withColumn("final_price", F.col("base_price") * TAX_FACTOR)


def in_category(df: DataFrame, category: str) -> DataFrame:
    return df.filter(F.col("category") == category)


def large_with_status(df: DataFrame, status: str, above: float = 1000) -> DataFrame:
    return df.filter((F.col("status") == status) & (F.col("amount") > above))


def region_or_priority(df: DataFrame, region: str, priority: str) -> DataFrame:
    return df.filter((F.col("region") == region) | (F.col("priority") == priority))


def rows_per_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "category")


def final_export(df: DataFrame, folder: str) -> DataFrame:
    """Store as Parquet, drop rows without a user, write those as CSV; gives the exported rows."""
    writers.parquet(df, f"{folder}/orders_parquet")
    known = readers.parquet(df.sparkSession, f"{folder}/orders_parquet").filter(F.col("user_id").isNotNull())
    writers.csv(known, f"{folder}/final_orders_csv")
    return known
