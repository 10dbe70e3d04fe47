"""The test tables as entities of this library, in Spark and as SQL for the comparison.

``Bound`` and ``VIEWS`` say the same thing twice; each registered query uses the first, its
SQL twin the second.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.money import money
from tallymart.plans.shop import Shop
from tallymart.session import tune


def order_status(code: Column) -> Column:
    """Nested and null-safe, so that a filter on the result becomes one on the column and reaches the scan."""
    return F.when(code.eqNullSafe("F"), "completed").otherwise(
        F.when(code.eqNullSafe("O"), "pending").otherwise("cancelled")
    )


class Bound:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- shop ----

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation_id"),
            money(F.col("c_acctbal")).alias("balance"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            F.col("p_size").alias("stock_qty"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            order_status(F.col("o_orderstatus")).alias("status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderpriority").alias("priority"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money(F.col("l_extendedprice")).alias("line_total"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    @cached_property
    def geography(self) -> DataFrame:
        regions = self.raw("region").select("r_regionkey", F.col("r_name").alias("region"))
        return (
            self.raw("nation")
            .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("country"), "region")
        )

    @cached_property
    def shop(self) -> Shop:
        return Shop(self.customers, self.products, self.orders, self.items)

    # ---- flat sales ----

    def sales(self, *parts: str) -> DataFrame:
        """Order lines with the named parts joined on: ``order``, ``customer``, ``geo``, ``product``."""
        lines = self.items.select(
            "order_id",
            "product_id",
            "line_no",
            "store_id",
            "ship_date",
            F.col("line_total").alias("sales"),
            "quantity",
            "discount",
            (F.col("line_total") * (F.lit("0.05").cast("decimal(4,2)") - F.col("discount"))).alias("profit"),
        )
        if "order" in parts or "customer" in parts or "geo" in parts:
            order = self.orders.select("order_id", "customer_id", "order_date", "status", "priority")
            if "customer" in parts or "geo" in parts:
                customer = self.customers.select(
                    "customer_id", F.col("name").alias("customer_name"), "segment", "nation_id", "balance"
                )
                order = order.join(customer, "customer_id")
            if "geo" in parts:
                order = order.join(self.geography, "nation_id")
            lines = lines.join(order.drop("nation_id"), "order_id")
        if "product" in parts:
            product = self.products.select("product_id", "product_name", "category", "brand", "unit_price")
            lines = lines.join(product, "product_id")
        return lines

    # ---- retail transactions ----

    @cached_property
    def retail(self) -> DataFrame:
        rows = self.sales("order", "customer", "geo", "product")
        balance = F.col("balance")
        return rows.select(
            F.col("customer_id").alias("user_id"),
            F.col("order_date").alias("transaction_date"),
            F.when(F.col("status") != "cancelled", F.col("status")).alias("status"),
            F.when(F.col("line_no") != 7, F.col("unit_price")).alias("price"),
            F.when(F.col("discount") < 0.1, F.col("sales")).alias("sale_amount"),
            F.when(F.col("quantity") < 50, F.col("sales")).alias("revenue"),
            F.when(
                ~((F.col("segment") == "FURNITURE") & (balance < 0)),
                F.concat(F.lower("customer_name"), F.lit("@mail.com")),
            ).alias("email"),
            F.when(balance.between(0, 500), "   ")
            .when(balance > 9500, None)
            .otherwise(F.col("customer_name"))
            .alias("username"),
            F.when(balance < 9000, F.col("quantity") + 15).alias("age"),
            F.when(balance > 5000, "Premium").when(balance > 0, "Basic").alias("subscription"),
            F.col("country").alias("city"),
            "region",
            F.col("category").alias("product_category"),
            F.when(F.col("line_no") == 6, "not a time")
            .otherwise(F.concat(F.col("ship_date").cast("string"), F.lit(" 08:30:00")))
            .alias("raw_timestamp"),
            F.concat(F.lit("STORE_"), F.col("store_id").cast("string")).alias("store_id"),
        )

    @cached_property
    def retail_with_copies(self) -> DataFrame:
        """Rows of the largest quantity class come twice."""
        copies = F.when(F.col("age") >= 60, 2).otherwise(1)
        return self.retail.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")

    # ---- order book ----

    @cached_property
    def order_book(self) -> DataFrame:
        rows = self.sales("order", "customer", "geo", "product")
        return rows.select(
            "order_id",
            F.when(F.col("balance") >= 0, F.col("customer_id")).alias("user_id"),
            F.col("product_id").cast("string").alias("product_id"),
            "category",
            "product_name",
            F.col("unit_price").cast("double").alias("base_price"),
            F.when(F.col("line_no") == 7, "n/a").otherwise(F.col("unit_price").cast("string")).alias("price"),
            F.col("sales").cast("double").alias("amount"),
            "quantity",
            "region",
            "priority",
            "status",
            F.col("order_date").cast("string").alias("order_date"),
        )

    # ---- offers ----

    @cached_property
    def offers(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("offer_id"),
            F.col("p_name").alias("title"),
            (size.cast("double") / 10).alias("rating"),
            F.when(F.col("p_brand") != "Brand#7", size.cast("double") * 2).alias("discount"),
            (F.col("p_retailprice") * size).alias("initial_price"),
            F.col("p_retailprice").alias("final_price"),
            F.col("p_type").alias("delivery_options"),
            F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("seller_name"),
            F.when(F.col("p_type") != "SMALL", F.concat_ws(" ", "p_brand", "p_type")).alias("seller_information"),
            F.lit(None).cast("string").alias("videos"),
            F.lit(None).cast("string").alias("what_customers_said"),
            F.lit(None).cast("string").alias("variations"),
        )

    # ---- dirty raw tables ----

    @cached_property
    def dirty_customers(self) -> DataFrame:
        key, balance = F.col("c_custkey"), F.col("c_acctbal")
        address = F.concat(F.lower("c_name"), F.lit("@x.com"))
        email = (
            F.when(balance < -800, None)
            .when(balance.between(1000, 1400), F.concat(F.lit(" \t"), F.upper(address), F.lit("  ")))
            .when(balance.between(1400, 1700), "NaN")
            .when(balance.between(1700, 2000), "  ")
            .otherwise(address)
        )
        signup = (
            F.when(balance.between(3000, 3300), "2099-13-45")
            .when(balance.between(3300, 3600), "")
            .when(F.col("c_mktsegment") == "MACHINERY", "2/9/2024")
            .otherwise("2024-02-29")
        )
        rows = (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("customer_id"),
                F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
                email.alias("email"),
                F.when(F.col("n_name") != "NATION_7", F.col("n_name")).alias("country"),
                signup.alias("signup_date"),
                F.col("c_mktsegment").alias("segment"),
                F.lit(1).alias("arrival"),
            )
        )
        copies = rows.filter(F.col("segment") == "BUILDING")
        later = rows.filter(F.col("segment") != "BUILDING").withColumn("email", F.lit("second@x.com"))
        return rows.unionByName(copies).unionByName(later.withColumn("arrival", F.lit(2)))

    @cached_property
    def dirty_products(self) -> DataFrame:
        price = F.col("p_retailprice")
        rows = self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.when(F.col("p_size") != 7, F.col("p_type")).alias("category"),
            F.when(F.col("p_size") == 1, None)
            .when(F.col("p_size") == 2, "-9.5")
            .when(F.col("p_size") == 3, "free")
            .when(F.col("p_size") == 4, "0")
            .otherwise(price.cast("decimal(10,2)").cast("string"))
            .alias("price"),
            F.when(F.col("p_brand") == "Brand#5", 0).otherwise(1).alias("active"),
            F.lit(1).alias("arrival"),
        )
        later = rows.filter(F.col("active") == 0).withColumn("price", F.lit("1.25")).withColumn("arrival", F.lit(2))
        return rows.unionByName(later)

    @cached_property
    def dirty_orders(self) -> DataFrame:
        price = F.col("total_amount")
        rows = self.orders.select(
            "order_id",
            F.when(price < 20000, -1 - F.col("customer_id")).otherwise(F.col("customer_id")).alias("customer_id"),
            F.when(price.between(20000, 30000), "2099-13-45")
            .when(price.between(30000, 40000), "2030-01-01")
            .otherwise(F.col("order_date").cast("string"))
            .alias("order_date"),
            F.when(price > 490000, "lost").otherwise(F.col("status")).alias("status"),
            F.lit(1).alias("arrival"),
        )
        copies = rows.filter(F.col("status") == "pending")
        later = rows.filter(F.col("status") == "lost").withColumn("status", F.lit("completed"))
        return rows.unionByName(copies).unionByName(later.withColumn("arrival", F.lit(2)))

    @cached_property
    def dirty_items(self) -> DataFrame:
        quantity = F.col("quantity")
        rows = self.items.select(
            "order_id",
            "product_id",
            "line_no",
            F.when(quantity == 50, "0")
            .when(quantity == 49, "-1")
            .when(quantity == 48, "many")
            .otherwise(quantity.cast("string"))
            .alias("quantity"),
            F.when(F.col("discount") == 0, None).otherwise(F.col("line_total").cast("string")).alias("unit_price"),
            "store_id",
            "ship_date",
        )
        orphans = rows.filter(F.col("line_no") == 7).withColumn("order_id", -1 - F.col("order_id"))
        return rows.unionByName(orphans)

    # ---- feeds ----

    @cached_property
    def order_target(self) -> DataFrame:
        return self.orders

    @cached_property
    def order_feed(self) -> DataFrame:
        """Urgent orders changed (one attribute to NULL), high ones unchanged, low ones as new keys."""
        changed = (
            self.orders.filter(F.col("priority") == "1-URGENT")
            .withColumn("total_amount", (F.col("total_amount") + 10).cast("decimal(12,2)"))
            .withColumn("status", F.when(F.col("status") != "pending", F.lit("returned")))
        )
        same = self.orders.filter(F.col("priority") == "2-HIGH")
        new = self.orders.filter(F.col("priority") == "5-LOW").withColumn("order_id", -1 - F.col("order_id"))
        return changed.unionByName(same).unionByName(new)


# The same in SQL. A view may use views above it.
VIEWS = {
    "shop_customers": """
        SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation_id,
               CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer""",
    "shop_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size AS stock_qty FROM part""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderpriority AS priority FROM orders""",
    "shop_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_no,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total,
               CAST(l_discount AS DECIMAL(4,2)) AS discount, l_suppkey AS store_id,
               CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""",
    "geography": """
        SELECT n_nationkey AS nation_id, n_name AS country, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sales": """
        SELECT i.order_id, i.product_id, i.line_no, i.store_id, i.ship_date, i.line_total AS sales, i.quantity,
               i.discount, i.line_total * (CAST('0.05' AS DECIMAL(4,2)) - i.discount) AS profit,
               o.customer_id, o.order_date, o.status, o.priority, c.name AS customer_name, c.segment, c.balance,
               g.country, g.region, p.product_name, p.category, p.brand, p.unit_price
        FROM shop_items i JOIN shop_orders o USING (order_id) JOIN shop_customers c USING (customer_id)
        JOIN geography g USING (nation_id) JOIN shop_products p USING (product_id)""",
    "retail": """
        SELECT customer_id AS user_id, order_date AS transaction_date,
               CASE WHEN status <> 'cancelled' THEN status END AS status,
               CASE WHEN line_no <> 7 THEN unit_price END AS price,
               CASE WHEN discount < 0.1 THEN sales END AS sale_amount,
               CASE WHEN quantity < 50 THEN sales END AS revenue,
               CASE WHEN NOT (segment = 'FURNITURE' AND balance < 0)
                    THEN lower(customer_name) || '@mail.com' END AS email,
               CASE WHEN balance BETWEEN 0 AND 500 THEN '   ' WHEN balance > 9500 THEN NULL
                    ELSE customer_name END AS username,
               CASE WHEN balance < 9000 THEN quantity + 15 END AS age,
               CASE WHEN balance > 5000 THEN 'Premium' WHEN balance > 0 THEN 'Basic' END AS subscription,
               country AS city, region, category AS product_category,
               CASE WHEN line_no = 6 THEN 'not a time'
                    ELSE CAST(ship_date AS VARCHAR) || ' 08:30:00' END AS raw_timestamp,
               'STORE_' || CAST(store_id AS VARCHAR) AS store_id
        FROM sales""",
    "retail_with_copies": "SELECT * FROM retail UNION ALL SELECT * FROM retail WHERE age >= 60",
    "order_book": """
        SELECT order_id, CASE WHEN balance >= 0 THEN customer_id END AS user_id,
               CAST(product_id AS VARCHAR) AS product_id, category, product_name,
               CAST(unit_price AS DOUBLE) AS base_price,
               CASE WHEN line_no = 7 THEN 'n/a' ELSE CAST(unit_price AS VARCHAR) END AS price,
               CAST(sales AS DOUBLE) AS amount, quantity, region, priority, status,
               CAST(order_date AS VARCHAR) AS order_date
        FROM sales""",
    "offers": """
        SELECT p_partkey AS offer_id, p_name AS title, CAST(p_size AS DOUBLE) / 10 AS rating,
               CASE WHEN p_brand <> 'Brand#7' THEN CAST(p_size AS DOUBLE) * 2 END AS discount,
               p_retailprice * p_size AS initial_price, p_retailprice AS final_price, p_type AS delivery_options,
               CASE WHEN p_type <> 'PROMO' THEN p_brand END AS seller_name,
               CASE WHEN p_type <> 'SMALL' THEN p_brand || ' ' || p_type END AS seller_information,
               CAST(NULL AS VARCHAR) AS videos, CAST(NULL AS VARCHAR) AS what_customers_said,
               CAST(NULL AS VARCHAR) AS variations
        FROM part""",
    "first_customers": """
        SELECT c_custkey AS customer_id, '  ' || c_name || ' ' AS name,
               CASE WHEN c_acctbal < -800 THEN NULL
                    WHEN c_acctbal BETWEEN 1000 AND 1400 THEN ' ' || chr(9) || upper(lower(c_name) || '@x.com') || '  '
                    WHEN c_acctbal BETWEEN 1400 AND 1700 THEN 'NaN'
                    WHEN c_acctbal BETWEEN 1700 AND 2000 THEN '  '
                    ELSE lower(c_name) || '@x.com' END AS email,
               CASE WHEN n_name <> 'NATION_7' THEN n_name END AS country,
               CASE WHEN c_acctbal BETWEEN 3000 AND 3300 THEN '2099-13-45'
                    WHEN c_acctbal BETWEEN 3300 AND 3600 THEN ''
                    WHEN c_mktsegment = 'MACHINERY' THEN '2/9/2024' ELSE '2024-02-29' END AS signup_date,
               c_mktsegment AS segment, 1 AS arrival
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dirty_customers": """
        SELECT * FROM first_customers
        UNION ALL SELECT * FROM first_customers WHERE segment = 'BUILDING'
        UNION ALL SELECT * REPLACE ('second@x.com' AS email, 2 AS arrival)
        FROM first_customers WHERE segment <> 'BUILDING'""",
    "first_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CASE WHEN p_size <> 7 THEN p_type END AS category,
               CASE p_size WHEN 1 THEN NULL WHEN 2 THEN '-9.5' WHEN 3 THEN 'free' WHEN 4 THEN '0'
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price,
               CASE WHEN p_brand = 'Brand#5' THEN 0 ELSE 1 END AS active, 1 AS arrival
        FROM part""",
    "dirty_products": """
        SELECT * FROM first_products
        UNION ALL SELECT * REPLACE ('1.25' AS price, 2 AS arrival) FROM first_products WHERE active = 0""",
    "first_orders": """
        SELECT order_id, CASE WHEN total_amount < 20000 THEN -1 - customer_id ELSE customer_id END AS customer_id,
               CASE WHEN total_amount BETWEEN 20000 AND 30000 THEN '2099-13-45'
                    WHEN total_amount BETWEEN 30000 AND 40000 THEN '2030-01-01'
                    ELSE CAST(order_date AS VARCHAR) END AS order_date,
               CASE WHEN total_amount > 490000 THEN 'lost' ELSE status END AS status, 1 AS arrival
        FROM shop_orders""",
    "dirty_orders": """
        SELECT * FROM first_orders
        UNION ALL SELECT * FROM first_orders WHERE status = 'pending'
        UNION ALL SELECT * REPLACE ('completed' AS status, 2 AS arrival) FROM first_orders WHERE status = 'lost'""",
    "first_items": """
        SELECT order_id, product_id, line_no,
               CASE quantity WHEN 50 THEN '0' WHEN 49 THEN '-1' WHEN 48 THEN 'many'
                    ELSE CAST(quantity AS VARCHAR) END AS quantity,
               CASE WHEN discount <> 0 THEN CAST(line_total AS VARCHAR) END AS unit_price, store_id, ship_date
        FROM shop_items""",
    "dirty_items": """
        SELECT * FROM first_items
        UNION ALL SELECT * REPLACE (-1 - order_id AS order_id) FROM first_items WHERE line_no = 7""",
    "order_feed": """
        SELECT * REPLACE (CAST(total_amount + 10 AS DECIMAL(12,2)) AS total_amount,
                          CASE WHEN status <> 'pending' THEN 'returned' END AS status)
        FROM shop_orders WHERE priority = '1-URGENT'
        UNION ALL SELECT * FROM shop_orders WHERE priority = '2-HIGH'
        UNION ALL SELECT * REPLACE (-1 - order_id AS order_id) FROM shop_orders WHERE priority = '5-LOW'""",
    # cleaned tables, by the rules of plans/shop_cleaning.py
    "ok_customers": r"""
        SELECT customer_id, trim(name) AS name, email, coalesce(country, 'Unknown') AS country, signup_date, segment,
               arrival
        FROM (SELECT * REPLACE (
                  CASE WHEN lower(regexp_replace(email, '^\s+|\s+$', '', 'g')) NOT IN ('nan', 'none', '')
                       THEN lower(regexp_replace(email, '^\s+|\s+$', '', 'g')) END AS email,
                  CASE WHEN signup_date LIKE '%/%' THEN CAST(try_strptime(signup_date, '%-m/%-d/%Y') AS DATE)
                       ELSE TRY_CAST(signup_date AS DATE) END AS signup_date),
                  row_number() OVER (PARTITION BY customer_id ORDER BY arrival) AS place
              FROM dirty_customers)
        WHERE place = 1 AND email IS NOT NULL AND signup_date IS NOT NULL""",
    "ok_products": """
        SELECT product_id, product_name, coalesce(category, 'Uncategorized') AS category, price, active, arrival
        FROM (SELECT * REPLACE (TRY_CAST(price AS DOUBLE) AS price),
                     row_number() OVER (PARTITION BY product_id ORDER BY arrival) AS place
              FROM dirty_products WHERE TRY_CAST(price AS DOUBLE) > 0)
        WHERE place = 1""",
    "ok_orders": """
        SELECT order_id, customer_id, order_date, status, arrival
        FROM (SELECT * REPLACE (TRY_CAST(order_date AS DATE) AS order_date),
                     row_number() OVER (PARTITION BY order_id ORDER BY arrival) AS place
              FROM dirty_orders)
        WHERE place = 1 AND order_date <= DATE '2025-12-31'
          AND status IN ('completed', 'cancelled', 'returned', 'pending')
          AND customer_id IN (SELECT customer_id FROM ok_customers)""",
    "ok_items": """
        SELECT order_id, product_id, line_no, quantity, unit_price, store_id, ship_date,
               CAST(CAST(quantity AS DECIMAL(12,2)) * CAST(unit_price AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS line_total
        FROM (SELECT * REPLACE (TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price),
                     row_number() OVER (PARTITION BY order_id, line_no
                                        ORDER BY product_id, store_id, ship_date, TRY_CAST(quantity AS DOUBLE),
                                                 TRY_CAST(unit_price AS DOUBLE)) AS place
              FROM dirty_items
              WHERE TRY_CAST(quantity AS DOUBLE) > 0 AND TRY_CAST(unit_price AS DOUBLE) > 0
                AND order_id IN (SELECT order_id FROM ok_orders)
                AND product_id IN (SELECT product_id FROM ok_products))
        WHERE place = 1""",
    "ok_sold_orders": "SELECT * FROM ok_orders WHERE order_id IN (SELECT order_id FROM ok_items)",
    # revenue building blocks
    "order_values": """
        SELECT o.order_id, o.customer_id, o.order_date, sum(i.line_total) AS value
        FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id
        WHERE o.status = 'completed' GROUP BY 1, 2, 3""",
    "spend": """
        SELECT c.customer_id, c.name, c.segment, sum(v.value) AS spend, count(*) AS num_orders,
               max(v.order_date) AS last_order
        FROM shop_customers c JOIN order_values v ON c.customer_id = v.customer_id GROUP BY 1, 2, 3""",
    "months": """
        SELECT strftime(order_date, '%Y-%m') AS month, sum(value) AS revenue, count(*) AS orders_count
        FROM order_values GROUP BY 1""",
    "today": "SELECT max(order_date) AS day FROM shop_orders WHERE status = 'completed'",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def _used(sql: str) -> list[str]:
    """Views that ``sql`` needs, in definition order."""
    found: set[str] = set()
    open_texts = [sql]
    while open_texts:
        for name in set(_WORD.findall(open_texts.pop())) & VIEWS.keys() - found:
            found.add(name)
            open_texts.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it uses."""
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in _used(sql)]
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {', '.join(views)}{', ' if views else ''}{body[5:]}"
    return f"WITH {', '.join(views)} {body}" if views else body


def sql_mean(sum_: str, count: str) -> str:
    """Mean of cents rounded half away from zero, in whole numbers, as double."""
    return (
        f"CASE WHEN {count} > 0 THEN sign({sum_}) * CAST((2 * CAST(abs({sum_}) * 100 AS HUGEINT) + {count}) "
        f"// (2 * {count}) AS DOUBLE) / 100 END"
    )


def sql_percent(part: str, whole: str) -> str:
    """100 * part / whole rounded half away from zero to two digits, in whole numbers, as double.

    ``part`` and ``whole`` have at most two decimals.
    """
    p, w = f"CAST({part} * 100 AS HUGEINT)", f"CAST({whole} * 100 AS HUGEINT)"
    return f"sign({p}) * CAST((20000 * abs({p}) + {w}) // (2 * {w}) AS DOUBLE) / 100"
