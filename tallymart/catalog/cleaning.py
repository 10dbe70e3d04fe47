"""Cleaning queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.functions import dates, text
from tallymart.operators import clean, ranking
from tallymart.plans import order_book, retail, shop_cleaning
from tallymart.session import materialise

ITEM_KEYS = ["order_id", "line_no"]
ITEM_ARRIVAL = ["product_id", "store_id", "ship_date", "quantity", "unit_price"]


ARRIVAL = {"customers": ["arrival"], "products": ["arrival"], "orders": ["arrival"], "items": ITEM_ARRIVAL}


def _raw(t) -> shop_cleaning.RawShop:
    return shop_cleaning.RawShop(t.dirty_customers, t.dirty_products, t.dirty_orders, t.dirty_items)


def cleaned_shop(t) -> shop_cleaning.CleanShop:
    return shop_cleaning.clean_shop(_raw(t), ARRIVAL, ITEM_KEYS)


@query(
    "clean_fill_const",
    """SELECT customer_id, arrival, coalesce(email, 'none@x.com') AS email, coalesce(country, 'Unknown') AS country FROM dirty_customers""",
)
def clean_fill_const(t):
    rows = t.dirty_customers.select("customer_id", "arrival", "email", "country")
    return clean.fill_constants(rows, {"email": "none@x.com", "country": "Unknown"})


@query("clean_fill_median", "SELECT offer_id, coalesce(discount, (SELECT median(discount) FROM offers)) AS discount FROM offers")
def clean_fill_median(t):
    return clean.fill_median(t.offers.select("offer_id", "discount"), "discount")


@query(
    "clean_median_sales",
    "SELECT CAST(median(CAST(l_extendedprice AS DOUBLE)) AS DOUBLE) AS median FROM lineitem",
)
def clean_median_sales(t):
    return ranking.median(t.raw("lineitem"), "l_extendedprice")


@query(
    "clean_fill_mode",
    """SELECT offer_id, coalesce(seller_name, (SELECT seller_name FROM offers WHERE seller_name IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS seller_name FROM offers""",
)
def clean_fill_mode(t):
    return clean.fill_mode(t.offers.select("offer_id", "seller_name"), "seller_name")


@query("clean_drop_null", "SELECT customer_id, arrival, email, country FROM dirty_customers WHERE email IS NOT NULL AND country IS NOT NULL")
def clean_drop_null(t):
    rows = t.dirty_customers.select("customer_id", "arrival", "email", "country")
    return clean.drop_null(rows, ["email", "country"])


@query("clean_drop_cols", "SELECT * EXCLUDE (videos, what_customers_said, variations) FROM offers")
def clean_drop_cols(t):
    return clean.drop_columns(t.offers, ["videos", "what_customers_said", "variations"])


@query("clean_dedup_rows", "SELECT DISTINCT * FROM dirty_customers")
def clean_dedup_rows(t):
    return clean.drop_duplicate_rows(t.dirty_customers)


@query("clean_dedup_any", "SELECT DISTINCT user_id, transaction_date, 'kept' AS survivor FROM retail", dates=["transaction_date"])
def clean_dedup_any(t):
    keys = ["user_id", "transaction_date"]
    kept = clean.keep_any(t.retail.select(*keys, "store_id"), keys)
    # which store survives is open, that one does is not
    survivor = F.when(F.col("store_id").isNotNull(), "kept")
    return kept.select(*keys, survivor.alias("survivor"))


@query(
    "clean_dedup_first",
    """SELECT order_id, line_no, product_id, CAST(line_total AS DOUBLE) AS line_total FROM (SELECT *, row_number() OVER (
       PARTITION BY order_id, line_no ORDER BY line_total, product_id, store_id, ship_date) AS place FROM shop_items) WHERE place = 1""",
)
def clean_dedup_first(t):
    first = clean.keep_first(t.items, ["order_id", "line_no"], ["line_total", "product_id", "store_id", "ship_date"])
    return first.select("order_id", "line_no", "product_id", F.col("line_total").cast("double").alias("line_total"))


@query(
    "clean_text_key",
    r"""SELECT customer_id, arrival, CASE WHEN k NOT IN ('nan', 'none', '') THEN k END AS email, trim(name) AS name FROM (
        SELECT *, lower(regexp_replace(email, '^\s+|\s+$', '', 'g')) AS k FROM dirty_customers)""",
)
def clean_text_key(t):
    return t.dirty_customers.select(
        "customer_id",
        "arrival",
        text.missing_to_null(text.text_key(F.col("email"))).alias("email"),
        text.strip_space(F.col("name")).alias("name"),
    )


@query(
    "clean_parse_date",
    "SELECT order_id, arrival, TRY_CAST(order_date AS DATE) AS order_date FROM dirty_orders WHERE TRY_CAST(order_date AS DATE) <= DATE '2025-12-31'",
    dates=["order_date"],
)
def clean_parse_date(t):
    parsed = t.dirty_orders.select("order_id", "arrival", dates.tolerant_date(F.col("order_date")).alias("order_date"))
    return clean.keep_until(clean.drop_null(parsed, ["order_date"]), "order_date", date(2025, 12, 31))


@query(
    "clean_parse_date_formats",
    "SELECT order_id, CASE WHEN order_id % 50 <> 7 THEN order_date END AS order_date FROM shop_orders",
    dates=["order_date"],
)
def clean_parse_date_formats(t):
    """Every spelling of a date that the feeds have, and a text that is none."""
    spelt = F.lit("13/13/2020 or so")
    for k, form in enumerate(dates.DATE_FORMATS):
        spelt = F.when((F.col("order_id") % 50 != 7) & (F.col("order_id") % 3 == k), F.date_format("order_date", form)).otherwise(spelt)
    return t.orders.select("order_id", dates.tolerant_date(spelt).alias("order_date"))


@query("clean_parse_num", "SELECT product_id, arrival, TRY_CAST(price AS DOUBLE) AS price FROM dirty_products WHERE TRY_CAST(price AS DOUBLE) > 0")
def clean_parse_num(t):
    parsed = t.dirty_products.select("product_id", "arrival", dates.tolerant_number(F.col("price")).alias("price"))
    return clean.keep_positive(parsed, ["price"])


@query("clean_domain", "SELECT order_id, arrival, status FROM dirty_orders WHERE status IN ('completed', 'cancelled', 'returned', 'pending')")
def clean_domain(t):
    rows = t.dirty_orders.select("order_id", "arrival", "status")
    return clean.keep_allowed(rows, "status", ["completed", "cancelled", "returned", "pending"])


@query("clean_fk", "SELECT order_id, arrival, customer_id FROM dirty_orders WHERE customer_id IN (SELECT customer_id FROM shop_customers)")
def clean_fk(t):
    return clean.keep_known(t.dirty_orders, t.customers, "customer_id").select("order_id", "arrival", "customer_id")


@query("clean_cascade", "SELECT order_id, status FROM shop_orders WHERE order_id IN (SELECT order_id FROM shop_items)")
def clean_cascade(t):
    return clean.keep_parents_with_children(t.orders, t.items, "order_id").select("order_id", "status")


@query(
    "clean_contact",
    "SELECT user_id, email, username, count(*) AS n FROM retail WHERE email IS NOT NULL AND trim(username, ' ') <> '' GROUP BY 1, 2, 3",
)
def clean_contact(t):
    return clean.keep_reachable(t.retail).groupBy("user_id", "email", "username").agg(F.count("*").alias("n"))


@query(
    "clean_cast_rename",
    """SELECT order_id, product_name AS item_name, TRY_CAST(price AS DOUBLE) AS unit_price, order_date AS Order_Date, region AS Sales_Region FROM order_book""",
)
def clean_cast_rename(t):
    typed = order_book.typed(t.order_book).select(
        "order_id",
        "item_name",
        F.col("price").alias("unit-price"),
        F.col("order_date").alias("Order Date"),
        F.col("region").alias("Sales/Region"),
    )
    return clean.standardise_names(typed)


@query(
    "clean_parse_timestamp",
    """SELECT store_id, count(*) AS n, count(event_time) AS n_valid, CAST(max(event_time) AS DATE) AS last_day FROM (
       SELECT store_id, TRY_CAST(raw_timestamp AS TIMESTAMP) AS event_time FROM retail) GROUP BY store_id""",
    dates=["last_day"],
)
def clean_parse_timestamp(t):
    parsed = clean.parse_timestamp(t.retail, "raw_timestamp", "event_time")
    return parsed.groupBy("store_id").agg(
        F.count("*").alias("n"),
        F.count("event_time").alias("n_valid"),
        F.max("event_time").cast("date").alias("last_day"),
    )


@query("clean_customers", "SELECT * FROM ok_customers", dates=["signup_date"])
def clean_customers(t):
    return shop_cleaning.clean_customers(t.dirty_customers, ["arrival"])


@query("clean_products", "SELECT * FROM ok_products")
def clean_products(t):
    return shop_cleaning.clean_products(t.dirty_products, ["arrival"])


@query("clean_orders", "SELECT * FROM ok_orders", dates=["order_date"])
def clean_orders(t):
    customers = materialise(shop_cleaning.clean_customers(t.dirty_customers, ["arrival"]))
    return shop_cleaning.clean_orders(t.dirty_orders, customers, ["arrival"])


@query("clean_items", "SELECT * REPLACE (CAST(line_total AS DOUBLE) AS line_total) FROM ok_items", dates=["ship_date"])
def clean_items(t):
    items = shop_cleaning.clean_tables(_raw(t), ARRIVAL, ITEM_KEYS).items
    return items.withColumn("line_total", F.col("line_total").cast("double"))


@query("clean_shop_orders", "SELECT order_id, customer_id, order_date, status FROM ok_sold_orders", dates=["order_date"])
def clean_shop_orders(t):
    tables = shop_cleaning.clean_tables(_raw(t), ARRIVAL, ITEM_KEYS)
    sold = clean.keep_parents_with_children(tables.orders, tables.items, "order_id")
    return sold.select("order_id", "customer_id", "order_date", "status")


@query(
    "clean_retail_rows",
    """SELECT city, count(*) AS n, CAST(sum(coalesce(revenue, 0)) AS DOUBLE) AS revenue FROM (SELECT DISTINCT * FROM retail_with_copies)
       WHERE email IS NOT NULL AND trim(username, ' ') <> '' GROUP BY city""",
)
def clean_retail_rows(t):
    rows = retail.handled(clean.drop_duplicate_rows(t.retail_with_copies))
    return rows.groupBy("city").agg(F.count("*").alias("n"), F.sum("revenue").cast("double").alias("revenue"))


@query(
    "clean_dirty_rows_removed",
    """SELECT (SELECT count(*) FROM shop_customers) AS n_original, 3 * (SELECT count(*) FROM shop_customers) AS n_dirty,
              2 * (SELECT count(*) FROM shop_customers) AS n_clean, CAST(0 AS BIGINT) AS n_null_names""",
)
def clean_dirty_rows_removed(t):
    """Copies and rows without a name are added; cleaning removes the copies and fills the names."""
    original = t.customers.select("customer_id", "name", "segment")
    no_names = original.withColumn("customer_id", -1 - F.col("customer_id")).withColumn(
        "name", F.lit(None).cast("string")
    )
    dirty = original.unionByName(original).unionByName(no_names)
    cleaned = materialise(clean.fill_constants(clean.drop_duplicate_rows(dirty), {"name": "Unknown"}))
    return cleaned.agg(
        F.count("*").alias("n_clean"), F.count_if(F.col("name").isNull()).alias("n_null_names")
    ).select(
        original.agg(F.count("*")).scalar().alias("n_original"),
        dirty.agg(F.count("*")).scalar().alias("n_dirty"),
        "n_clean",
        "n_null_names",
    )
