"""Applying feeds to snapshots: upsert, type-2 history, stock updates, normalisation.

Each function takes snapshots and returns the next snapshot; the caller writes it to a new
path. The feed is the small side: Spark broadcasts it where its size is below
``spark.sql.autoBroadcastJoinThreshold`` and then the target is not shuffled at all. ``upsert``
counts the rows of the feed for that, since the size of compressed files says little of their memory.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.operators.joins import changed_rows, differs
from tallymart.session import materialise
from tallymart.sources import writers

KEY_BYTES = 64  # of a row in a broadcast hash table, at least
TASK_BYTES = 16 << 20  # of rows of a feed in one task


def stored_feed(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` stored once, or an error where a key is NULL or repeated.

    The merge reads the feed several times; stored, it is computed once and Spark knows its size.
    """
    feed = materialise(source, "feed")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    bad = feed.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter((F.col("n_rows") > 1) | any_null).head(1)
    if bad:
        raise ValueError(f"the feed repeats a key or has none: {bad[0].asDict()}")
    return feed


def _typed_like(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns out of ``source``, with the target's types."""
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
) -> DataFrame:
    """Matched keys take the source's values (its NULLs too), new keys are added, nothing is deleted."""
    keys = list(keys)
    update = [c for c in target.columns if c not in keys] if update_columns is None else list(update_columns)
    feed = stored_feed(_typed_like(source, target), keys)
    n_rows, threshold = feed.count(), feed.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if n_rows * KEY_BYTES > threshold:
        return _upsert_large(target, feed, keys, update, n_rows)
    news = feed.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit"))
    updated = target.join(news, keys, "left").select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
          for c in target.columns]
    )
    known = target.select(*keys).join(feed.select(*keys), keys, "left_semi").distinct()  # at most the feed's keys
    return updated.unionByName(feed.join(known, keys, "left_anti"))


def _upsert_large(target: DataFrame, feed: DataFrame, keys: list[str], update: list[str], n_rows: int) -> DataFrame:
    """``upsert`` of a feed that is no hash table's size: one sort-merge join, so a task sorts one part of either side.

    The number of parts is fixed, as Spark would join small ones by their compressed size. Target rows without a key pass by.
    """
    spark, named = feed.sparkSession, F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows * 16 * len(feed.columns) / TASK_BYTES))
    others = [c for c in target.columns if c not in keys]
    news = feed.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_hit"))
    olds = target.filter(named).withColumn("_old", F.lit(True))
    merged = olds.repartition(n, *keys).join(news.repartition(n, *keys), keys, "full").select(
        *[F.when(F.col("_hit") if c in update else F.col("_old").isNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
          if c in others else F.col(c) for c in target.columns]
    )
    return merged.unionByName(target.filter(~named))


def merge_metrics(
    target: DataFrame, source: DataFrame, keys: Sequence[str], as_of: date | None = None
) -> DataFrame:
    """One row: target rows updated, inserted and left unchanged by ``upsert``."""
    keys = list(keys)
    feed = stored_feed(source.select(*keys), keys)
    known = target.select(*keys).join(feed, keys, "left_semi")
    count = lambda df: df.agg(F.count("*")).scalar()
    return (
        known.agg(F.count("*").alias("rows_updated"))
        .withColumn("rows_inserted", count(feed) - F.col("rows_updated"))
        .withColumn("rows_unchanged", count(target) - F.col("rows_updated"))
        .withColumn("as_of", _day(as_of))
    )


def _day(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def scd2_init(df: DataFrame, as_of: date | None = None) -> DataFrame:
    return (
        df.withColumn("effective_date", _day(as_of))
        .withColumn("end_date", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(True))
    )


def scd2_changes(
    history: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Source rows that differ from the current version in a tracked column."""
    return changed_rows(source, history.filter("is_current"), list(keys), list(tracked), null_safe)


def scd2_apply(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Close the current version of changed keys, open a new one for changed and new keys.

    Closed versions pass through without a join. Keys that the feed does not name stay current.
    """
    keys, tracked = list(keys), list(tracked)
    feed = stored_feed(_typed_like(source, history.drop("effective_date", "end_date", "is_current")), keys)
    current = history.filter("is_current")
    past = history.filter(~F.coalesce(F.col("is_current"), F.lit(False)))

    news = feed.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in tracked], F.lit(True).alias("_hit"))
    compared = current.join(news, keys, "left")
    replaced = F.coalesce(F.col("_hit") & differs(tracked, null_safe), F.lit(False))
    closed = compared.select(
        *[c for c in history.columns if c not in ("end_date", "is_current")],
        F.when(replaced, _day(as_of)).otherwise(F.col("end_date")).alias("end_date"),
        (~replaced).alias("is_current"),
    )
    untouched = current.select(*keys, *tracked).join(news, keys).filter(~replaced).select(*keys).distinct()
    opened = scd2_init(feed.join(untouched, keys, "left_anti"), as_of)
    return past.unionByName(closed).unionByName(opened.select(*history.columns))


def upsert_table(name: str, source: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """``upsert`` into a table by name: the next snapshot goes to ``path``, then the table points there."""
    writers.publish(upsert(source.sparkSession.table(name), source, keys), name, path)
    return source.sparkSession.table(name)


def scd2_history(history: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All versions of the keys that the feed names, in time order."""
    keys = list(keys)
    return history.join(source.select(*keys).distinct(), keys, "left_semi").orderBy(*keys, "effective_date")


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``condition`` holds; the other rows, also those where it is unknown, stay."""
    return df.select(
        *[
            F.when(condition, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def reduce_stock(products: DataFrame, sold: DataFrame) -> DataFrame:
    """Subtract the sold quantity per product from ``stock_qty``."""
    taken = sold.groupBy("product_id").agg(F.sum("quantity").alias("_taken"))
    left = F.col("stock_qty") - F.coalesce(F.col("_taken"), F.lit(0))
    return products.join(taken, "product_id", "left").select(
        *[left.cast(products.schema[c].dataType).alias(c) if c == "stock_qty" else F.col(c) for c in products.columns]
    )


class Placement(NamedTuple):
    """The three next snapshots, and the rule violations that forbid writing them."""

    orders: DataFrame
    items: DataFrame
    products: DataFrame
    violations: DataFrame


def place_orders(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    new_orders: DataFrame,
    new_items: DataFrame,
    item_key: Sequence[str] | None = None,
) -> Placement:
    """Add orders with their items and take the items out of stock, as one unit.

    Order ids have to be new and unique, and so has ``item_key`` where items have one. Write the snapshots only
    where ``violations`` is empty (see ``accept``).
    """
    item_keys = [] if item_key is None else [
        quality.primary_key("order_items", new_items, item_key),
        quality.new_key("order_items", new_items, item_key, items),
    ]
    next_orders = orders.unionByName(new_orders)
    next_items = items.unionByName(new_items)
    next_products = reduce_stock(products, new_items)
    violations = quality.report(
        quality.primary_key("orders", new_orders, ["order_id"]),
        quality.new_key("orders", new_orders, ["order_id"], orders),
        *item_keys,
        quality.not_null("orders", new_orders, ["customer_id"]),
        quality.not_null("order_items", new_items, ["order_id", "product_id", "quantity"]),
        quality.foreign_key("orders", new_orders, "customer_id", customers),
        quality.foreign_key("order_items", new_items, "order_id", next_orders),
        quality.foreign_key("order_items", new_items, "product_id", products),
        quality.row_rules("orders", new_orders, {"total_amount >= 0": F.col("total_amount") >= 0}),
        quality.row_rules("order_items", new_items, {"quantity > 0": F.col("quantity") > 0}),
        quality.row_rules("products", next_products, {"stock_qty >= 0": F.col("stock_qty") >= 0}),
    ).filter("n_violations > 0")
    return Placement(next_orders, next_items, next_products, violations)


def accept(placement: Placement) -> Placement:
    """``placement`` itself, or an error that names the broken rules."""
    broken = placement.violations.collect()  # one row per rule
    if broken:
        raise ValueError("order refused: " + "; ".join(f"{r.table_name}: {r.rule}" for r in broken))
    return placement


class Normalised(NamedTuple):
    customers: DataFrame
    products: DataFrame
    orders: DataFrame


def normalise_sales(flat: DataFrame) -> Normalised:
    """Split a flat sales table into customers, products (one row per id) and order lines."""
    customers = flat.select("customer_id", "customer_name", "segment").distinct()
    products = flat.groupBy("product_id").agg(
        *[F.max(c).alias(c) for c in ("product_name", "category", "sub_category") if c in flat.columns]
    )
    lines = ("row_id", "order_id", "order_date", "customer_id", "product_id", "sales", "quantity", "discount", "profit")
    return Normalised(customers, products, flat.select(*[c for c in lines if c in flat.columns]))
