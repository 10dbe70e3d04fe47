"""Cleaning of the four raw shop tables, each step in the order that the result depends on.

``order`` names the columns that give the arrival order of the rows ("first" copy).
Keeping the first row per key also removes exact copies, so there is no separate step for those.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.functions.dates import DATE_FORMATS, tolerant_date, tolerant_number
from tallymart.functions.money import MONEY
from tallymart.functions.text import missing_to_null, strip_space, text_key
from tallymart.operators import clean, profile
from tallymart.session import materialise, together

LAST_DAY = date(2025, 12, 31)  # fixed value: orders after this day are entry errors


def clean_customers(df: DataFrame, order: Sequence[str], formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """First copy per customer; dropped if that copy has no email or no valid signup date."""
    df = df.withColumn("email", missing_to_null(text_key(F.col("email"))))
    df = clean.keep_first(df, ["customer_id"], order)
    df = clean.drop_null(df, ["email"])
    df = clean.fill_constants(df, {"country": schemas.DEFAULT_COUNTRY})
    df = df.withColumn("signup_date", tolerant_date(F.col("signup_date"), formats))
    df = clean.drop_null(df, ["signup_date"])
    return df.withColumn("name", strip_space(F.col("name")))


def clean_products(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Copies without a positive price do not count as the first one."""
    df = df.withColumn("price", tolerant_number(F.col("price")))
    df = clean.keep_positive(df, ["price"])
    df = clean.fill_constants(df, {"category": schemas.DEFAULT_CATEGORY})
    return clean.keep_first(df, ["product_id"], order)


def clean_orders(
    df: DataFrame,
    customers: DataFrame,
    order: Sequence[str],
    last_day: date = LAST_DAY,
    formats: tuple[str, ...] = DATE_FORMATS,
) -> DataFrame:
    df = clean.keep_first(df, ["order_id"], order)
    df = df.withColumn("order_date", tolerant_date(F.col("order_date"), formats))
    df = clean.keep_until(df, "order_date", last_day)
    df = clean.keep_allowed(df, "status", schemas.ORDER_STATUSES)
    return clean.keep_known(df, customers, "customer_id")


def clean_items(
    df: DataFrame, orders: DataFrame, products: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    df = df.withColumn("quantity", tolerant_number(F.col("quantity")))
    df = df.withColumn("unit_price", tolerant_number(F.col("unit_price")))
    df = clean.keep_positive(df, ["quantity", "unit_price"])
    df = clean.keep_known(df, products, "product_id")
    df = clean.keep_known(df, orders, "order_id")  # last, so that keys within an order need no further shuffle
    df = clean.keep_first(df, keys, order)
    exact = F.col("quantity").cast("decimal(12,2)") * F.col("unit_price").cast(MONEY)
    return df.withColumn("line_total", F.bround(exact, 2).cast(MONEY))


class RawShop(NamedTuple):
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame


class CleanShop(NamedTuple):
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame
    audit: DataFrame


def clean_tables(
    raw: RawShop, arrival: dict[str, Sequence[str]], item_keys: Sequence[str], last_day: date = LAST_DAY
) -> RawShop:
    """All four tables, each later one checked against the earlier ones, which are stored; items are left to the caller.

    ``arrival`` maps each table name to its arrival order.
    """
    customers, products = together(
        lambda: materialise(clean_customers(raw.customers, arrival["customers"]), "customers"),
        lambda: materialise(clean_products(raw.products, arrival["products"]), "products"),
    )
    orders = materialise(clean_orders(raw.orders, customers, arrival["orders"], last_day), "orders")
    return RawShop(customers, products, orders, clean_items(raw.items, orders, products, item_keys, arrival["items"]))


def clean_shop(
    raw: RawShop, arrival: dict[str, Sequence[str]], item_keys: Sequence[str], last_day: date = LAST_DAY
) -> CleanShop:
    """``clean_tables`` with the items stored, orders left without items removed, and the audit of all steps."""
    customers, products, orders, items = clean_tables(raw, arrival, item_keys, last_day)
    items = materialise(items, "items")
    sold = materialise(clean.keep_parents_with_children(orders, items, "order_id"), "orders")
    audit = profile.step_audit(
        [
            ("customers", "clean", raw.customers, customers),
            ("products", "clean", raw.products, products),
            ("orders", "clean", raw.orders, orders),
            ("order_items", "clean", raw.items, items),
            ("orders", "without items", orders, sold),
        ]
    )
    return CleanShop(customers, products, sold, items, audit)
