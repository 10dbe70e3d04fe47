"""Filters, projections, joins, aggregates, sorts, sets, subqueries, functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.catalog.tables import order_status, sql_mean, sql_percent
from tallymart.functions import dates, money, text
from tallymart.operators import joins, profile, ranking, sketches
from tallymart.session import materialise

# ---- projections and filters -----------------------------------------------------------


@query("proj_select", "SELECT customer_id, name AS customer_name, segment FROM shop_customers")
def proj_select(t):
    return t.customers.select("customer_id", F.col("name").alias("customer_name"), "segment")


@query("proj_star", "SELECT order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount, priority FROM shop_orders", dates=["order_date"])
def proj_star(t):
    return t.orders.alias("o").select("o.*").withColumn("total_amount", F.col("total_amount").cast("double"))


@query(
    "proj_derived",
    """SELECT offer_id, initial_price - initial_price * discount / 100 AS total_amount,
              final_price * CAST(1.18 AS DOUBLE) AS with_tax, TRUE AS is_current, DATE '2026-01-01' AS loaded_on,
              CAST(NULL AS DATE) AS end_date FROM offers""",
    dates=["loaded_on", "end_date"],
)
def proj_derived(t):
    price = F.col("initial_price")
    return t.offers.select(
        "offer_id",
        (price - price * F.col("discount") / 100).alias("total_amount"),
        (F.col("final_price") * 1.18).alias("with_tax"),
        F.lit(True).alias("is_current"),
        F.lit(date(2026, 1, 1)).alias("loaded_on"),
        F.lit(None).cast("date").alias("end_date"),
    )


@query("proj_line_total", "SELECT order_id, line_no, product_id, CAST(round(quantity * line_total, 2) AS DOUBLE) AS gross FROM shop_items")
def proj_line_total(t):
    gross = F.col("quantity") * F.col("line_total")
    return t.items.select("order_id", "line_no", "product_id", money.to_double(gross).alias("gross"))


@query("flt_compare", "SELECT product_id, product_name, CAST(unit_price AS DOUBLE) AS unit_price FROM shop_products WHERE unit_price > 950")
def flt_compare(t):
    return t.raw("part").filter(F.col("p_retailprice") > 950).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("unit_price"),
    )


@query("flt_and", "SELECT order_id, customer_id FROM shop_orders WHERE status = 'completed' AND total_amount > 400000")
def flt_and(t):
    rows = t.raw("orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000))
    return rows.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))


@query("flt_or", "SELECT order_id, status, priority FROM shop_orders WHERE status = 'pending' OR priority = '1-URGENT'")
def flt_or(t):
    # both sides on raw columns, so that the whole condition reaches the Parquet scan
    either = (F.col("o_orderstatus") == "O") | (F.col("o_orderpriority") == "1-URGENT")
    rows = t.raw("orders").filter(either)
    return rows.select(F.col("o_orderkey").alias("order_id"), order_status(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"))


@query("flt_not_equal", "SELECT order_id, status FROM order_feed WHERE status <> 'cancelled'")
def flt_not_equal(t):
    return t.order_feed.filter(F.col("status") != "cancelled").select("order_id", "status")


@query("flt_ignore_case", "SELECT product_id, category FROM shop_products WHERE lower(category) = 'promo'")
def flt_ignore_case(t):
    return t.products.filter(text.same_ignoring_case(F.col("category"), "Promo")).select("product_id", "category")


@query("flt_between", "SELECT order_id, order_date FROM shop_orders WHERE order_date BETWEEN DATE '1997-08-10' AND DATE '1997-08-25'", dates=["order_date"])
def flt_between(t):
    # on the raw column, so that the range reaches the Parquet scan
    days = F.col("o_orderdate").between(
        F.lit("1997-08-10").cast("timestamp_ntz"), F.lit("1997-08-25").cast("timestamp_ntz")
    )
    return t.raw("orders").filter(days).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date")
    )


@query("flt_in", "SELECT order_id, priority FROM shop_orders WHERE priority IN ('1-URGENT', '2-HIGH')")
def flt_in(t):
    return t.orders.filter(F.col("priority").isin("1-URGENT", "2-HIGH")).select("order_id", "priority")


@query("flt_null", "SELECT customer_id, email IS NULL AS no_email FROM dirty_customers WHERE email IS NULL OR country IS NOT NULL")
def flt_null(t):
    rows = t.dirty_customers.filter(F.col("email").isNull() | F.col("country").isNotNull())
    return rows.select("customer_id", F.col("email").isNull().alias("no_email"))


@query("flt_year", "SELECT order_id, year(order_date) AS order_year FROM shop_orders WHERE year(order_date) = 1997")
def flt_year(t):
    day = F.col("o_orderdate")
    first, after = F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")
    return t.raw("orders").filter((day >= first) & (day < after)).select(
        F.col("o_orderkey").alias("order_id"), F.year(day).cast("long").alias("order_year")
    )


@query(
    "case_tier",
    """SELECT product_id, CASE WHEN unit_price < 930 THEN 'Budget' WHEN unit_price BETWEEN 930 AND 960 THEN 'Mid-Range'
              ELSE 'Premium' END AS price_tier FROM shop_products""",
)
def case_tier(t):
    price = F.col("unit_price")
    tier = F.when(price < 930, "Budget").when(price.between(930, 960), "Mid-Range").otherwise("Premium")
    return t.products.select("product_id", tier.alias("price_tier"))


@query(
    "case_guard",
    """SELECT order_id, line_no, product_id, CASE WHEN discount IS NULL OR discount = 0 THEN NULL
              ELSE quantity / CAST(discount AS DOUBLE) END AS per_discount FROM shop_items""",
)
def case_guard(t):
    d = F.col("discount")
    guarded = F.when(d.isNull() | (d == 0), None).otherwise(F.col("quantity") / d.cast("double"))
    return t.items.select("order_id", "line_no", "product_id", guarded.alias("per_discount"))


@query(
    "cnt_filters",
    """SELECT count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (total_amount > 400000) AS large,
              count(*) FILTER (status = 'completed' AND total_amount > 400000) AS completed_large FROM shop_orders""",
)
def cnt_filters(t):
    done, large = F.col("status") == "completed", F.col("total_amount") > 400000
    return t.orders.agg(
        F.count_if(done).alias("completed"),
        F.count_if(large).alias("large"),
        F.count_if(done & large).alias("completed_large"),
    )


# ---- joins -----------------------------------------------------------------------------


@query("join_inner2", "SELECT o.order_id, o.order_date, c.name FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id", dates=["order_date"])
def join_inner2(t):
    return t.orders.join(t.customers, "customer_id").select("order_id", "order_date", "name")


@query(
    "join_inner3",
    """SELECT o.order_id, o.status, p.product_name, i.line_no, i.quantity
       FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id JOIN shop_products p ON i.product_id = p.product_id""",
)
def join_inner3(t):
    rows = t.items.join(t.orders, "order_id").join(t.products, "product_id")
    return rows.select("order_id", "status", "product_name", "line_no", "quantity")


_PAID = "(SELECT * FROM shop_orders WHERE status = 'completed')"


@query("join_left", f"SELECT c.customer_id, c.name, o.order_id, o.order_date FROM shop_customers c LEFT JOIN {_PAID} o ON c.customer_id = o.customer_id", dates=["order_date"])
def join_left(t):
    done = t.orders.filter(F.col("status") == "completed").select("customer_id", "order_id", "order_date")
    return joins.keep_all_parents(t.customers.select("customer_id", "name"), done, "customer_id")


@query("join_right", "SELECT o.order_id, o.customer_id, c.name FROM shop_customers c RIGHT JOIN shop_orders o ON c.customer_id = o.customer_id AND c.balance > 0")
def join_right(t):
    solvent = t.customers.filter(F.col("balance") > 0).select("customer_id", "name")
    return solvent.join(t.orders, "customer_id", "right").select("order_id", "customer_id", "name")


@query("join_cross_bound", "SELECT o.order_id, date_diff('day', o.order_date, b.day) AS days_ago FROM shop_orders o CROSS JOIN today b")
def join_cross_bound(t):
    last = t.orders.filter(F.col("status") == "completed").agg(F.max("order_date")).scalar()
    return t.orders.select("order_id", F.datediff(last, "order_date").cast("long").alias("days_ago"))


@query("join_anti", f"SELECT c.customer_id, c.name FROM shop_customers c ANTI JOIN {_PAID} o ON c.customer_id = o.customer_id")
def join_anti(t):
    done = t.orders.filter(F.col("status") == "completed").select("customer_id").distinct()
    return t.customers.join(done, "customer_id", "left_anti").select("customer_id", "name")


@query(
    "join_orphans",
    """SELECT 'dirty_orders' AS table_name, count(*) AS orphans FROM dirty_orders o
       LEFT JOIN shop_customers c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL
       UNION ALL SELECT 'dirty_items', count(*) FROM dirty_items i
       LEFT JOIN shop_orders o ON i.order_id = o.order_id WHERE o.order_id IS NULL""",
)
def join_orphans(t):
    return profile.row_counts(
        {
            "dirty_orders": joins.orphans(t.dirty_orders, t.customers, "customer_id"),
            "dirty_items": joins.orphans(t.dirty_items, t.orders, "order_id"),
        }
    ).withColumnRenamed("n_rows", "orphans")


@query("join_semi", "SELECT customer_id, name FROM shop_customers WHERE customer_id IN (SELECT customer_id FROM shop_orders WHERE total_amount > 400000)")
def join_semi(t):
    large = t.orders.filter(F.col("total_amount") > 400000).select("customer_id").distinct()
    return t.customers.join(large, "customer_id", "left_semi").select("customer_id", "name")


@query(
    "join_changed",
    """SELECT f.order_id, f.status, CAST(f.total_amount AS DOUBLE) AS total_amount FROM order_feed f JOIN shop_orders o
       ON f.order_id = o.order_id WHERE f.status <> o.status OR f.total_amount <> o.total_amount""",
)
def join_changed(t):
    changed = joins.changed_rows(t.order_feed, t.orders, ["order_id"], ["status", "total_amount"], null_safe=False)
    return changed.select("order_id", "status", F.col("total_amount").cast("double").alias("total_amount"))


@query(
    "join_agg_subquery",
    """SELECT o.order_id, o.status, CAST(v.value AS DOUBLE) AS order_value FROM shop_orders o
       JOIN (SELECT order_id, sum(line_total) AS value FROM shop_items GROUP BY order_id) v ON o.order_id = v.order_id""",
)
def join_agg_subquery(t):
    values = t.items.groupBy("order_id").agg(money.total("line_total").alias("order_value"))
    return t.orders.select("order_id", "status").join(values, "order_id")


@query(
    "join_cte",
    """WITH totals AS (SELECT customer_id, sum(total_amount) AS total FROM shop_orders GROUP BY 1),
            big AS (SELECT * FROM totals WHERE total > 2000000),
            lines AS (SELECT customer_id, count(*) AS num_orders FROM shop_orders GROUP BY 1)
       SELECT c.name, CAST(b.total AS DOUBLE) AS total, l.num_orders
       FROM big b JOIN lines l ON b.customer_id = l.customer_id JOIN shop_customers c ON c.customer_id = b.customer_id""",
)
def join_cte(t):
    # both steps group by the same key, so one aggregation serves them
    totals = t.orders.groupBy("customer_id").agg(
        F.sum("total_amount").alias("total"), F.count("*").alias("num_orders")
    )
    big = totals.filter(F.col("total") > 2000000)
    return big.join(t.customers, "customer_id").select("name", F.col("total").cast("double").alias("total"), "num_orders")


@query("join_using", "SELECT order_id, priority, line_no, product_id FROM shop_orders JOIN shop_items USING (order_id)")
def join_using(t):
    rows = t.items.select("order_id", "line_no", "product_id").join(t.orders.select("order_id", "priority"), "order_id")
    return rows.select("order_id", "priority", "line_no", "product_id")


# ---- aggregates ------------------------------------------------------------------------


@query(
    "agg_global",
    f"""SELECT count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total, CAST(min(total_amount) AS DOUBLE) AS lowest,
               CAST(max(total_amount) AS DOUBLE) AS highest, {sql_mean('sum(total_amount)', 'count(*)')} AS average,
               CAST(sum(total_amount) FILTER (status = 'completed') AS DOUBLE) AS completed_total FROM shop_orders""",
)
def agg_global(t):
    amount = F.col("total_amount")
    return t.orders.agg(
        F.count("*").alias("total_orders"),
        money.total(amount).alias("total"),
        F.min(amount).cast("double").alias("lowest"),
        F.max(amount).cast("double").alias("highest"),
        money.mean(F.sum(amount), F.count("*")).alias("average"),
        money.total(F.when(F.col("status") == "completed", amount)).alias("completed_total"),
    )


@query("agg_sum", "SELECT product_id, CAST(sum(line_total) AS DOUBLE) AS total_sales FROM shop_items GROUP BY product_id")
def agg_sum(t):
    return t.items.groupBy("product_id").agg(money.total("line_total").alias("total_sales"))


@query("agg_count", "SELECT category, count(*) AS count FROM shop_products GROUP BY category")
def agg_count(t):
    return t.products.groupBy("category").count()


@query("agg_avg", f"SELECT category, {sql_mean('sum(unit_price)', 'count(*)')} AS average_price FROM shop_products GROUP BY category")
def agg_avg(t):
    return t.products.groupBy("category").agg(money.mean(F.sum("unit_price"), F.count("*")).alias("average_price"))


@query("agg_minmax", "SELECT category, CAST(max(unit_price) AS DOUBLE) AS highest_price, CAST(min(unit_price) AS DOUBLE) AS lowest_price FROM shop_products GROUP BY category")
def agg_minmax(t):
    return t.products.groupBy("category").agg(
        F.max("unit_price").cast("double").alias("highest_price"),
        F.min("unit_price").cast("double").alias("lowest_price"),
    )


@query("agg_count_sum", "SELECT status, count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM shop_orders GROUP BY status")
def agg_count_sum(t):
    return t.orders.groupBy("status").agg(
        F.count("*").alias("total_orders"), money.total("total_amount").alias("total_revenue")
    )


@query(
    "agg_stats",
    f"""SELECT store_id, count(*) AS n, CAST(sum(line_total) AS DOUBLE) AS total, {sql_mean('sum(line_total)', 'count(*)')} AS mean,
               CAST(min(line_total) AS DOUBLE) AS lowest, CAST(max(line_total) AS DOUBLE) AS highest
        FROM shop_items GROUP BY store_id""",
)
def agg_stats(t):
    value = F.col("line_total")
    return t.items.groupBy("store_id").agg(
        F.count("*").alias("n"),
        money.total(value).alias("total"),
        money.mean(F.sum(value), F.count("*")).alias("mean"),
        F.min(value).cast("double").alias("lowest"),
        F.max(value).cast("double").alias("highest"),
    )


@query("agg_distinct", "SELECT store_id, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products FROM shop_items GROUP BY store_id")
def agg_distinct(t):
    return sketches.distinct_counts(t.items, ["store_id"], {"orders": "order_id", "products": "product_id"})


@query(
    "agg_distinct_sketches",
    """SELECT year(order_date) AS order_year, count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders, TRUE AS customers_close, TRUE AS orders_close
       FROM shop_orders GROUP BY 1""",
)
def agg_distinct_sketches(t):
    """Sketches per day, stored and united per year, against the exact counts."""
    columns = {"customers": "customer_id", "orders": "order_id"}
    per_day = materialise(sketches.distinct_sketches(t.orders, ["order_date"], columns), "distinct-sketches")
    year = F.year("order_date").cast("long").alias("order_year")
    united = sketches.united_distinct_counts(per_day.select(year, *columns), ["order_year"], list(columns))
    exact = sketches.distinct_counts(t.orders.select(year, *columns.values()), ["order_year"], columns)
    bound = sketches.relative_error()
    close = [(F.abs(F.col(f"u.{c}") - F.col(f"e.{c}")) <= F.col(f"e.{c}") * bound).alias(f"{c}_close") for c in columns]
    return exact.alias("e").join(united.alias("u"), "order_year").select("order_year", "e.customers", "e.orders", *close)


@query("agg_distinct_global", "SELECT count(DISTINCT customer_id) AS customers FROM shop_orders")
def agg_distinct_global(t):
    return t.orders.agg(F.count_distinct("customer_id").alias("customers"))


@query("agg_having", "SELECT brand, count(*) AS n FROM shop_products GROUP BY brand HAVING avg(unit_price) > 950")
def agg_having(t):
    groups = t.products.groupBy("brand").agg(F.count("*").alias("n"), F.avg("unit_price").alias("_avg"))
    return groups.filter(F.col("_avg") > 950).drop("_avg")


@query(
    "agg_conditional",
    """SELECT priority, sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END)::BIGINT AS completed,
              sum(CASE WHEN status <> 'completed' THEN 1 ELSE 0 END)::BIGINT AS not_completed FROM shop_orders GROUP BY priority""",
)
def agg_conditional(t):
    done = F.col("status") == "completed"
    return t.orders.groupBy("priority").agg(F.count_if(done).alias("completed"), F.count_if(~done).alias("not_completed"))


@query(
    "agg_max_min",
    """SELECT customer_id, CAST(max(total_amount) AS DOUBLE) AS highest, min(strftime(order_date, '%Y-%m')) AS first_month,
              max(order_date) AS last_date, max(priority) AS last_priority FROM shop_orders GROUP BY customer_id""",
    dates=["last_date"],
)
def agg_max_min(t):
    return t.orders.groupBy("customer_id").agg(
        F.max("total_amount").cast("double").alias("highest"),
        dates.month_label(F.min("order_date")).alias("first_month"),
        F.max("order_date").alias("last_date"),
        F.max("priority").alias("last_priority"),
    )


@query(
    "agg_two_level",
    f"""SELECT priority, count(*) AS num_orders, {sql_mean('sum(value)', 'count(*)')} AS mean_value
        FROM (SELECT o.order_id, o.priority, sum(i.line_total) AS value FROM shop_orders o
              JOIN shop_items i ON o.order_id = i.order_id GROUP BY 1, 2) GROUP BY priority""",
)
def agg_two_level(t):
    values = t.items.groupBy("order_id").agg(F.sum("line_total").alias("value"))
    return (
        t.orders.select("order_id", "priority")
        .join(values, "order_id")
        .groupBy("priority")
        .agg(F.count("*").alias("num_orders"), money.mean(F.sum("value"), F.count("*")).alias("mean_value"))
    )


@query(
    "agg_share",
    f"SELECT priority, count(*) AS n, {sql_percent('count(*)', '(SELECT count(*) FROM shop_orders)')} AS pct FROM shop_orders GROUP BY priority",
)
def agg_share(t):
    every = t.orders.agg(F.count("*")).scalar()
    groups = t.orders.groupBy("priority").agg(F.count("*").alias("n"))
    return groups.withColumn("pct", money.percent(F.col("n"), every))


@query("agg_by_expr", "SELECT strftime(order_date, '%Y-%m') AS month, CAST(sum(total_amount) AS DOUBLE) AS total FROM shop_orders GROUP BY month")
def agg_by_expr(t):
    return t.orders.groupBy(dates.month_label(F.col("order_date")).alias("month")).agg(
        money.total("total_amount").alias("total")
    )


@query("agg_multi_key", "SELECT customer_id, status, priority, count(*) AS n FROM shop_orders GROUP BY customer_id, status, priority")
def agg_multi_key(t):
    return t.orders.groupBy("customer_id", "status", "priority").agg(F.count("*").alias("n"))


@query("distinct_proj", "SELECT DISTINCT customer_id, strftime(order_date, '%Y-%m') AS activity_month FROM shop_orders")
def distinct_proj(t):
    return t.orders.select("customer_id", dates.month_label(F.col("order_date")).alias("activity_month")).distinct()


# ---- sorts, limits ---------------------------------------------------------------------


@query("sort_multi", """SELECT customer_id, country, email, row_number() OVER (ORDER BY country NULLS FIRST, customer_id, email NULLS FIRST) AS place
       FROM dirty_customers ORDER BY place""")
def sort_multi(t):
    rows = t.dirty_customers.select("customer_id", "country", "email")
    return ranking.row_number(rows, ["country", "customer_id", "email"], "place").orderBy("place")


@query("topk", "SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount FROM shop_orders ORDER BY total_amount DESC, order_id LIMIT 10")
def topk(t):
    rows = t.orders.select("order_id", F.col("total_amount").cast("double").alias("total_amount"))
    return rows.orderBy(*ranking.sort_keys(["-total_amount", "order_id"])).limit(10)


@query("topk_first", "SELECT order_id FROM shop_orders ORDER BY total_amount DESC, order_id LIMIT 1")
def topk_first(t):
    return t.orders.orderBy(F.desc("total_amount"), "order_id").select("order_id").limit(1)


@query("bottomk", "SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount FROM shop_orders ORDER BY total_amount, order_id LIMIT 5")
def bottomk(t):
    rows = t.orders.select("order_id", F.col("total_amount").cast("double").alias("total_amount"))
    return rows.orderBy("total_amount", "order_id").limit(5)


# ---- sets and subqueries ---------------------------------------------------------------


@query(
    "set_union_by_name",
    """SELECT customer_id, name, 'customer' AS kind FROM shop_customers
       UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def set_union_by_name(t):
    buyers = t.customers.select("customer_id", "name", F.lit("customer").alias("kind"))
    sellers = t.raw("supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("customer_id")
    )
    return buyers.unionByName(sellers)


@query("sub_scalar", "SELECT order_id FROM shop_orders WHERE total_amount > (SELECT sum(total_amount) / count(*) FROM shop_orders)")
def sub_scalar(t):
    mean = t.orders.agg(F.avg("total_amount")).scalar()
    return t.orders.filter(F.col("total_amount") > mean).select("order_id")


@query(
    "sub_scalar_cte",
    """WITH totals AS (SELECT customer_id, sum(total_amount) AS total FROM shop_orders GROUP BY 1)
       SELECT customer_id, CAST(total AS DOUBLE) AS total FROM totals WHERE total > (SELECT avg(total) FROM totals)""",
)
def sub_scalar_cte(t):
    totals = t.orders.groupBy("customer_id").agg(F.sum("total_amount").alias("total"))
    above = totals.filter(F.col("total") > totals.agg(F.avg("total")).scalar())
    return above.withColumn("total", F.col("total").cast("double"))


# ---- functions -------------------------------------------------------------------------


@query(
    "fn_dates",
    """SELECT order_id, strftime(order_date, '%Y-%m') AS month, year(order_date) AS year,
              (year(order_date) * 12 + month(order_date)) - (1995 * 12 + 1) AS month_index,
              date_diff('day', order_date, DATE '2002-01-01') AS days, CAST(trunc(CAST(total_amount AS DOUBLE)) AS BIGINT) AS whole
       FROM shop_orders""",
)
def fn_dates(t):
    day = F.col("order_date")
    return t.orders.select(
        "order_id",
        dates.month_label(day).alias("month"),
        F.year(day).cast("long").alias("year"),
        (dates.month_number(day) - dates.month_number(F.lit(date(1995, 1, 1)))).cast("long").alias("month_index"),
        F.datediff(F.lit(date(2002, 1, 1)), day).cast("long").alias("days"),
        F.col("total_amount").cast("double").cast("long").alias("whole"),
    )


@query(
    "fn_round",
    """SELECT order_id, line_no, product_id, CAST(round(line_total, 0) AS DOUBLE) AS half_up,
              CAST(CASE WHEN (line_total * 2) % 2 = 1 THEN floor(line_total / 2 + CAST(0.5 AS DECIMAL(2,1))) * 2
                   ELSE round(line_total, 0) END AS DOUBLE) AS half_even FROM shop_items""",
)
def fn_round(t):
    value = F.col("line_total")
    return t.items.select(
        "order_id",
        "line_no",
        "product_id",
        F.round(value, 0).cast("double").alias("half_up"),
        F.bround(value, 0).cast("double").alias("half_even"),
    )


@query(
    "fn_text",
    r"""SELECT customer_id, arrival, lower(regexp_replace(email, '^\s+|\s+$', '', 'g')) AS email_key, trim(name, ' ') AS name,
               name || '|' || segment AS label, substring(name, 4, 7) AS part FROM dirty_customers""",
)
def fn_text(t):
    return t.dirty_customers.select(
        "customer_id",
        "arrival",
        text.text_key(F.col("email")).alias("email_key"),
        F.trim("name").alias("name"),
        F.concat("name", F.lit("|"), "segment").alias("label"),
        F.substring("name", 4, 7).alias("part"),
    )


@query(
    "fn_null_case",
    """SELECT customer_id, arrival, CASE WHEN country IS NULL THEN 'unknown' WHEN country IN ('NATION_1', 'NATION_2') THEN 'near'
              ELSE 'far' END AS zone, customer_id BETWEEN 100 AND 900 AS in_range FROM dirty_customers""",
)
def fn_null_case(t):
    country = F.col("country")
    zone = F.when(country.isNull(), "unknown").when(country.isin("NATION_1", "NATION_2"), "near").otherwise("far")
    return t.dirty_customers.select(
        "customer_id", "arrival", zone.alias("zone"), F.col("customer_id").between(100, 900).alias("in_range")
    )
