"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.operators import merge, quality


@query(
    "dq_pk",
    """SELECT 'primary_key' AS rule, 'order_items' AS table_name, 'order_id,line_no' AS key, count(*) AS n_violations
       FROM (SELECT order_id, line_no FROM shop_items GROUP BY 1, 2 HAVING count(*) > 1)
       UNION ALL SELECT 'primary_key', 'orders', 'order_id', count(*) FROM (SELECT order_id FROM shop_orders GROUP BY 1 HAVING count(*) > 1)""",
)
def dq_pk(t):
    return quality.report(
        quality.primary_key("order_items", t.items, ["order_id", "line_no"]),
        quality.primary_key("orders", t.orders, ["order_id"]),
    )


@query("dq_pk_rows", "SELECT customer_id, count(*) AS n_rows FROM dirty_customers GROUP BY 1 HAVING count(*) > 1 OR customer_id IS NULL")
def dq_pk_rows(t):
    return quality.primary_key_violations(t.dirty_customers, ["customer_id"])


@query(
    "dq_notnull",
    """SELECT 'not_null ' || c AS rule, 'customers' AS table_name, '' AS key, n AS n_violations FROM (
       SELECT 'email' AS c, count(*) FILTER (email IS NULL) AS n FROM dirty_customers
       UNION ALL SELECT 'country', count(*) FILTER (country IS NULL) FROM dirty_customers
       UNION ALL SELECT 'name', count(*) FILTER (name IS NULL) FROM dirty_customers)""",
)
def dq_notnull(t):
    return quality.not_null("customers", t.dirty_customers, ["email", "country", "name"])


@query("dq_unique", "SELECT email, count(*) AS n_rows FROM dirty_customers WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(t):
    return quality.unique_violations(t.dirty_customers, ["email"])


@query(
    "dq_check",
    """SELECT 'price > 0' AS rule, 'products' AS table_name, '' AS key, count(*) FILTER (TRY_CAST(price AS DOUBLE) <= 0) AS n_violations FROM dirty_products
       UNION ALL SELECT 'active in (0, 1)', 'products', '', count(*) FILTER (active NOT IN (0, 1)) FROM dirty_products""",
)
def dq_check(t):
    return quality.row_rules(
        "products",
        t.dirty_products,
        {"price > 0": F.col("price").try_cast("double") > 0, "active in (0, 1)": F.col("active").isin(0, 1)},
    )


@query("dq_check_rows", "SELECT order_id, product_id, line_no, quantity FROM dirty_items WHERE TRY_CAST(quantity AS DOUBLE) <= 0")
def dq_check_rows(t):
    rows = quality.rule_violations(t.dirty_items, F.col("quantity").try_cast("double") > 0)
    return rows.select("order_id", "product_id", "line_no", "quantity")


@query(
    "dq_domain",
    """SELECT 'domain status' AS rule, 'orders' AS table_name, '' AS key,
       count(*) FILTER (status NOT IN ('completed', 'cancelled', 'returned', 'pending')) AS n_violations FROM dirty_orders""",
)
def dq_domain(t):
    return quality.domain("orders", t.dirty_orders, {"status": ["completed", "cancelled", "returned", "pending"]})


@query(
    "dq_fk",
    """SELECT 'foreign_key' AS rule, 'orders' AS table_name, 'customer_id' AS key, count(*) AS n_violations FROM dirty_orders
       WHERE customer_id NOT IN (SELECT customer_id FROM shop_customers)
       UNION ALL SELECT 'foreign_key', 'order_items', 'order_id', count(*) FROM dirty_items WHERE order_id NOT IN (SELECT order_id FROM shop_orders)
       UNION ALL SELECT 'foreign_key', 'order_items', 'product_id', count(*) FROM dirty_items WHERE product_id NOT IN (SELECT product_id FROM shop_products)""",
)
def dq_fk(t):
    return quality.report(
        quality.foreign_key("orders", t.dirty_orders, "customer_id", t.customers),
        quality.foreign_key("order_items", t.dirty_items, "order_id", t.orders),
        quality.foreign_key("order_items", t.dirty_items, "product_id", t.products),
    )


@query(
    "dq_fk_keys",
    "SELECT customer_id, count(*) AS n_rows FROM dirty_orders WHERE customer_id NOT IN (SELECT customer_id FROM shop_customers) GROUP BY 1",
)
def dq_fk_keys(t):
    return quality.foreign_key_violations(t.dirty_orders, "customer_id", t.customers)


@query(
    "dq_not_before",
    """SELECT 'ship_date not before order_date' AS rule, 'order_items' AS table_name, 'order_id' AS key,
              count(*) FILTER (ship_date < order_date) AS n_violations FROM shop_items JOIN shop_orders USING (order_id)""",
)
def dq_not_before(t):
    return quality.not_before("order_items", t.items, "ship_date", t.orders, "order_date", "order_id")


@query("dq_defaults", "SELECT product_id, arrival, coalesce(category, 'Uncategorized') AS category, coalesce(price, '0') AS price FROM dirty_products")
def dq_defaults(t):
    rows = t.dirty_products.select("product_id", "arrival", "category", "price")
    return quality.apply_defaults(rows, {"category": "Uncategorized", "price": "0"})


@query(
    "dq_reconcile",
    """SELECT 'orders' AS table_name, e AS expected, a AS actual, e = a AS ok FROM (
       SELECT (SELECT count(*) FROM shop_orders) + (SELECT count(*) FROM shop_orders WHERE priority = '5-LOW') AS e,
              (SELECT count(*) FROM shop_orders WHERE order_id NOT IN (SELECT order_id FROM order_feed)) + (SELECT count(*) FROM order_feed) AS a)""",
)
def dq_reconcile(t):
    merged = merge.upsert(t.orders, t.order_feed, ["order_id"])
    before = t.orders.agg(F.count("*")).scalar()
    new = t.orders.filter(F.col("priority") == "5-LOW").agg(F.count("*")).scalar()
    return quality.reconcile({"orders": before + new}, {"orders": merged})


@query(
    "dq_keys_unique",
    "SELECT n AS n_rows, n AS n_keys, TRUE AS ok FROM (SELECT count(*) + (SELECT count(*) FROM shop_orders WHERE priority = '5-LOW') AS n FROM shop_orders)",
)
def dq_keys_unique(t):
    return quality.keys_unique(merge.upsert(t.orders, t.order_feed, ["order_id"]), ["order_id"])


@query(
    "dq_spot_check",
    """SELECT order_id, status, priority FROM (SELECT * FROM order_feed UNION ALL SELECT * FROM shop_orders
       WHERE order_id NOT IN (SELECT order_id FROM order_feed)) WHERE priority IN ('1-URGENT', '5-LOW')""",
)
def dq_spot_check(t):
    merged = merge.upsert(t.orders, t.order_feed, ["order_id"])
    rows = merged.filter(F.col("priority").isin("1-URGENT", "5-LOW")).select("order_id", "status", "priority")
    return rows.orderBy("order_id")
