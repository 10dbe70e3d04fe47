"""Feeds applied to snapshots."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.operators import merge
from tallymart.session import new_path
from tallymart.sources import writers
from tallymart.streaming.feeds import FeedHistory

DAY1, DAY2 = date(2026, 1, 1), date(2026, 2, 1)
TRACKED = ["status", "total_amount", "priority"]
_COLUMNS = "order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount, priority"


def _plain(df):
    return df.withColumn("total_amount", F.col("total_amount").cast("double"))


@query(
    "merge_scd1",
    f"SELECT {_COLUMNS} FROM (SELECT * FROM order_feed UNION ALL SELECT * FROM shop_orders WHERE order_id NOT IN (SELECT order_id FROM order_feed))",
    dates=["order_date"],
)
def merge_scd1(t):
    return _plain(merge.upsert(t.orders, t.order_feed, ["order_id"]))


@query(
    "merge_table",
    f"SELECT {_COLUMNS} FROM (SELECT * FROM order_feed UNION ALL SELECT * FROM shop_orders WHERE order_id NOT IN (SELECT order_id FROM order_feed))",
    dates=["order_date"],
)
def merge_table(t):
    """The feed merged into a table by name."""
    name = f"tallymart_{uuid.uuid4().hex}"
    writers.replace_table(t.orders, name, new_path(t.spark, "table"))
    return _plain(merge.upsert_table(name, t.order_feed, ["order_id"], new_path(t.spark, "table")))


@query(
    "merge_scd1_columns",
    """SELECT order_id, CASE WHEN f_hit THEN f_status ELSE status END AS status, CAST(total_amount AS DOUBLE) AS total_amount FROM (
         SELECT o.*, f.status AS f_status, f.order_id IS NOT NULL AS f_hit FROM shop_orders o LEFT JOIN order_feed f ON o.order_id = f.order_id)
       UNION ALL SELECT order_id, status, CAST(total_amount AS DOUBLE) FROM order_feed WHERE order_id NOT IN (SELECT order_id FROM shop_orders)""",
)
def merge_scd1_columns(t):
    merged = merge.upsert(t.orders, t.order_feed, ["order_id"], update_columns=["status"])
    return _plain(merged.select("order_id", "status", "total_amount"))


@query(
    "merge_metrics",
    """SELECT u AS rows_updated, f - u AS rows_inserted, n - u AS rows_unchanged, DATE '2026-01-01' AS as_of FROM (
       SELECT (SELECT count(*) FROM shop_orders WHERE order_id IN (SELECT order_id FROM order_feed)) AS u,
              (SELECT count(*) FROM order_feed) AS f, (SELECT count(*) FROM shop_orders) AS n)""",
    dates=["as_of"],
)
def merge_metrics(t):
    return merge.merge_metrics(t.orders, t.order_feed, ["order_id"], DAY1)


@query(
    "scd2_init",
    f"SELECT {_COLUMNS}, DATE '2026-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM shop_orders",
    dates=["order_date", "effective_date", "end_date"],
)
def scd2_init(t):
    return _plain(merge.scd2_init(t.orders, DAY1))


@query(
    "scd2_init_today",
    f"SELECT {_COLUMNS}, current_date AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM shop_orders",
    dates=["order_date", "effective_date", "end_date"],
)
def scd2_init_today(t):
    return _plain(merge.scd2_init(t.orders))


_DIFFERS = " OR ".join(f"f.{c} IS DISTINCT FROM o.{c}" for c in TRACKED)
_CHANGED = f"SELECT f.* FROM order_feed f JOIN shop_orders o ON f.order_id = o.order_id WHERE {_DIFFERS}"


@query("scd2_changes", f"SELECT {_COLUMNS} FROM ({_CHANGED})", dates=["order_date"])
def scd2_changes(t):
    return _plain(merge.scd2_changes(merge.scd2_init(t.orders, DAY1), t.order_feed, ["order_id"], TRACKED))


_HISTORY = f"""WITH changed AS ({_CHANGED}),
    opened AS (SELECT * FROM changed UNION ALL SELECT * FROM order_feed WHERE order_id NOT IN (SELECT order_id FROM shop_orders)),
    history AS (
      SELECT *, DATE '2026-01-01' AS effective_date,
             CASE WHEN order_id IN (SELECT order_id FROM changed) THEN DATE '2026-02-01' END AS end_date,
             order_id NOT IN (SELECT order_id FROM changed) AS is_current FROM shop_orders
      UNION ALL SELECT *, DATE '2026-02-01', NULL, TRUE FROM opened)"""


def _history(t):
    return merge.scd2_apply(merge.scd2_init(t.orders, DAY1), t.order_feed, ["order_id"], TRACKED, DAY2)


@query("scd2_apply", f"{_HISTORY} SELECT {_COLUMNS}, effective_date, end_date, is_current FROM history", dates=["order_date", "effective_date", "end_date"])
def scd2_apply(t):
    return _plain(_history(t))


@query("scd2_apply_twice", f"{_HISTORY} SELECT {_COLUMNS}, effective_date, end_date, is_current FROM history", dates=["order_date", "effective_date", "end_date"])
def scd2_apply_twice(t):
    """The same feed once more changes nothing."""
    return _plain(merge.scd2_apply(_history(t), t.order_feed, ["order_id"], TRACKED, date(2026, 3, 1)))


@query(
    "scd2_history",
    f"""{_HISTORY} SELECT {_COLUMNS}, effective_date, end_date, is_current FROM history
        WHERE order_id IN (SELECT order_id FROM order_feed)""",
    dates=["order_date", "effective_date", "end_date"],
)
def scd2_history(t):
    return _plain(merge.scd2_history(_history(t), t.order_feed, ["order_id"]))


@query(
    "update_where",
    """SELECT product_id, CASE WHEN category = 'PROMO' THEN stock_qty - 1 ELSE stock_qty END AS stock_qty,
              CASE WHEN category = 'PROMO' THEN 'sold' ELSE brand END AS brand FROM shop_products""",
)
def update_where(t):
    changed = {"stock_qty": F.col("stock_qty") - 1, "brand": F.lit("sold")}
    products = t.products.select("product_id", "category", "stock_qty", "brand")
    return merge.update_where(products, F.col("category") == "PROMO", changed).drop("category")


@query(
    "stock_update",
    """SELECT p.product_id, p.stock_qty - coalesce(s.taken, 0)::INT AS stock_qty FROM shop_products p LEFT JOIN (
       SELECT product_id, sum(quantity) AS taken FROM shop_items GROUP BY 1) s ON p.product_id = s.product_id""",
)
def stock_update(t):
    return merge.reduce_stock(t.products, t.items).select("product_id", "stock_qty")


def _placement(t):
    """The pending orders and their items are the new ones."""
    old = t.orders.filter(F.col("status") != "pending")
    new = t.orders.filter(F.col("status") == "pending")
    lines = t.items.select("order_id", "product_id", "quantity")
    new_lines = lines.join(new.select("order_id"), "order_id", "left_semi")
    old_lines = lines.join(new.select("order_id"), "order_id", "left_anti")
    return merge.place_orders(t.customers, t.products, old, old_lines, new, new_lines)


_SOLD = """SELECT product_id, sum(quantity) AS taken FROM shop_items
    WHERE order_id IN (SELECT order_id FROM shop_orders WHERE status = 'pending') GROUP BY 1"""


@query(
    "apply_orders",
    f"""SELECT p.product_id, p.stock_qty - coalesce(s.taken, 0)::INT AS stock_qty,
               (SELECT count(*) FROM shop_orders) AS n_orders, (SELECT count(*) FROM shop_items) AS n_items
        FROM shop_products p LEFT JOIN ({_SOLD}) s ON p.product_id = s.product_id""",
)
def apply_orders(t):
    placed = _placement(t)
    return placed.products.select(
        "product_id",
        "stock_qty",
        placed.orders.agg(F.count("*")).scalar().alias("n_orders"),
        placed.items.agg(F.count("*")).scalar().alias("n_items"),
    )


@query(
    "apply_orders_violations",
    f"""SELECT 'stock_qty >= 0' AS rule, 'products' AS table_name, '' AS key, count(*) AS n_violations
        FROM shop_products p JOIN ({_SOLD}) s ON p.product_id = s.product_id WHERE p.stock_qty < s.taken HAVING count(*) > 0""",
)
def apply_orders_violations(t):
    return _placement(t).violations


@query("normalize_customers", "SELECT DISTINCT customer_id, customer_name, segment FROM sales")
def normalize_customers(t):
    return _normalised(t).customers


@query("normalize_products", "SELECT store_id AS product_id, max(product_name) AS product_name, max(category) AS category FROM sales GROUP BY store_id")
def normalize_products(t):
    # a store has many product names, so that the maximum per id matters
    flat = t.sales("customer", "product").withColumn("product_id", F.col("store_id"))
    return merge.normalise_sales(flat).products


@query(
    "normalize_orders",
    """SELECT order_id, order_date, customer_id, product_id, CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount,
              CAST(profit AS DOUBLE) AS profit FROM sales""",
    dates=["order_date"],
)
def normalize_orders(t):
    lines = _normalised(t).orders
    return lines.select(*[F.col(c).cast("double").alias(c) if c in ("sales", "discount", "profit") else c for c in lines.columns])


def _normalised(t):
    return merge.normalise_sales(t.sales("customer", "product"))


_STATES = ["status", "priority"]
_FEED_VERSIONS = """WITH feed AS (
      SELECT customer_id, order_date AS day, status, priority, order_id AS latest_order FROM shop_orders
      QUALIFY row_number() OVER (PARTITION BY customer_id, order_date ORDER BY order_id DESC) = 1),
    seen AS (
      SELECT *, row_number() OVER w AS place, lag(status) OVER w AS status_before, lag(priority) OVER w AS priority_before
      FROM feed WINDOW w AS (PARTITION BY customer_id ORDER BY day)),
    changes AS (SELECT * FROM seen WHERE place = 1 OR status IS DISTINCT FROM status_before OR priority IS DISTINCT FROM priority_before),
    versions AS (
      SELECT customer_id, status, priority, latest_order, day AS effective_date, lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS end_date
      FROM changes)"""


def _followed(t) -> FeedHistory:
    """The last order of every customer and day, as files of three periods that arrive one after the other."""
    last = F.max_by(F.struct("status", "priority", F.col("order_id").alias("latest_order")), "order_id").alias("last")
    feed = t.orders.groupBy("customer_id", F.col("order_date").cast("date").alias("day")).agg(last).select("customer_id", "day", "last.*")
    folder, mark = new_path(t.spark, "feed"), new_path(t.spark, "mark")
    history = FeedHistory(t.spark, new_path(t.spark, "history"), feed.schema, ["customer_id"], _STATES, "day").create()
    for first, last_year in ((None, 1993), (1994, 1995), (1996, None)):
        year = F.year("day")
        feed.filter((year >= first if first else F.lit(True)) & (year <= last_year if last_year else F.lit(True))).write.mode("append").parquet(folder)
        history.follow(folder, mark)
    return history


@query(
    "feed_history",
    f"{_FEED_VERSIONS} SELECT *, end_date IS NULL AS is_current FROM versions",
    dates=["effective_date", "end_date"],
)
def feed_history(t):
    return _followed(t).versions()


@query("feed_current", f"{_FEED_VERSIONS} SELECT customer_id, status, priority, latest_order, effective_date FROM versions WHERE end_date IS NULL", dates=["effective_date"])
def feed_current(t):
    return _followed(t).current()
