"""Questions on a flat sales table (one row per order line)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.dates import month_label, month_slice
from tallymart.operators import profile


def total_by(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Sum of a measure per key, largest first."""
    out = f"total_{measure}"
    return df.groupBy(key).agg(F.sum(measure).cast("double").alias(out)).orderBy(F.desc(out), key)


def top_by(df: DataFrame, key: str, measure: str, limit: int = 10) -> DataFrame:
    return total_by(df, key, measure).limit(limit)


def bottom_by(df: DataFrame, key: str, measure: str, limit: int = 5) -> DataFrame:
    out = f"total_{measure}"
    return df.groupBy(key).agg(F.sum(measure).cast("double").alias(out)).orderBy(out, key).limit(limit)


def in_region(df: DataFrame, region: str) -> DataFrame:
    return df.filter(F.col("region") == region)


def in_category(df: DataFrame, category: str) -> DataFrame:
    return df.filter(F.col("category") == category)


def sales_above(df: DataFrame, amount: float) -> DataFrame:
    return df.filter(F.col("sales") > amount)


def monthly_trend(df: DataFrame) -> DataFrame:
    """Sales per ``MM-yyyy`` label; ``month`` is the label that sorts in time order."""
    label = month_slice(F.date_format("order_date", "dd-MM-yyyy"))
    return (
        df.groupBy(label.alias("month_year"), month_label(F.col("order_date")).alias("month"))
        .agg(F.sum("sales").cast("double").alias("total_sales"))
        .orderBy("month_year")
    )


def repeated_orders(df: DataFrame) -> DataFrame:
    """Order ids on more than one line."""
    return profile.duplicate_keys(df, ["order_id"])
