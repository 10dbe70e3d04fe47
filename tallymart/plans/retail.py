"""Retail transactions: cleaning, subscriber and region questions, store summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import money as m
from tallymart.functions.text import is_blank
from tallymart.operators import clean

# What stands in for a missing entry.
AMOUNT_DEFAULTS = {"price": 0.0, "sale_amount": 0.0, "revenue": 0.0}
DEFAULTS = {**AMOUNT_DEFAULTS, "status": "Unknown"}
ALL_DEFAULTS = {**DEFAULTS, "age": 0, "subscription": "Basic"}


def handled(df: DataFrame) -> DataFrame:
    """Numbers and labels filled, unreachable contacts dropped."""
    return clean.keep_reachable(clean.fill_constants(df, ALL_DEFAULTS))


def premium_by_age(df: DataFrame, youngest: int = 18, oldest: int = 30) -> DataFrame:
    return df.filter(F.col("age").between(youngest, oldest) & (F.col("subscription") == "Premium"))


def in_region(df: DataFrame, region: str) -> DataFrame:
    return df.filter(F.col("region") == region)


def large_sales(df: DataFrame, category: str, above: float = 1000) -> DataFrame:
    return df.filter((F.col("product_category") == category) & (F.col("sale_amount") > above))


def price_statistics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("price").alias("count"),
        m.to_double(F.min("price")).alias("min_price"),
        m.to_double(F.max("price")).alias("max_price"),
        m.mean(F.sum("price"), F.count("price")).alias("avg_price"),
        m.to_double(F.sum("price")).alias("total_price"),
    )


def sales_by_region(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("region")
        .agg(
            F.count("sale_amount").alias("num_transactions"),
            m.to_double(F.sum("sale_amount")).alias("total_sales"),
            m.mean(F.sum("sale_amount"), F.count("sale_amount")).alias("avg_sale"),
            m.to_double(F.min("sale_amount")).alias("min_sale"),
            m.to_double(F.max("sale_amount")).alias("max_sale"),
        )
        .orderBy(F.desc("total_sales"), "region")
    )


def busy_cities(df: DataFrame, more_than: int = 50) -> DataFrame:
    return (
        df.groupBy("city")
        .agg(F.count("*").alias("record_count"))
        .filter(F.col("record_count") > more_than)
        .orderBy(F.desc("record_count"), "city")
    )


def category_average(df: DataFrame, region: str) -> DataFrame:
    return (
        in_region(df, region)
        .groupBy("product_category")
        .agg(m.mean(F.sum("sale_amount"), F.count("sale_amount")).alias("avg_sale_amount"))
        .orderBy(F.desc("avg_sale_amount"), "product_category")
    )


def store_revenue(df: DataFrame) -> DataFrame:
    """From raw transactions to revenue per store: copies out, gaps filled, contacts checked, time parsed."""
    df = clean.drop_duplicate_rows(df)
    df = clean.keep_reachable(clean.fill_constants(df, DEFAULTS))
    df = clean.parse_timestamp(df, "raw_timestamp", "event_time")
    return (
        df.groupBy("store_id")
        .agg(
            m.to_double(F.sum("revenue")).alias("total_revenue"),
            F.count("*").alias("transaction_count"),
            m.mean(F.sum("price"), F.count("price")).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"), "store_id")
    )


def step_counts(df: DataFrame) -> DataFrame:
    """Raw rows, rows without copies, reachable rows and their stores, counted in one pass."""
    reachable = F.col("email").isNotNull() & ~is_blank(F.col("username"))
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("_copies"))
        .agg(
            F.sum("_copies").alias("raw_rows"),
            F.count("*").alias("distinct_rows"),
            F.count_if(reachable).alias("clean_rows"),
            F.count_distinct(F.when(reachable, F.col("store_id"))).alias("stores"),
        )
    )
