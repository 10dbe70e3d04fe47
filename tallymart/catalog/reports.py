"""Named reports and analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.catalog.tables import sql_mean, sql_percent
from tallymart.functions import money
from tallymart.operators import joins
from tallymart.plans import customer_sales, deals, flat_sales, order_book, retail, shop
from tallymart.session import new_path

# ---- shop reports ----------------------------------------------------------------------

@query(
    "rep_revenue_by_customer",
    "SELECT customer_id, name, segment, CAST(spend AS DOUBLE) AS total_revenue, num_orders AS total_orders FROM spend",
)
def revenue_by_customer(t):
    return shop.revenue_by_customer(t.shop)


_PRODUCT_SALES = """WITH sold AS (SELECT p.product_id, p.product_name, p.category, sum(i.line_total) AS revenue,
        sum(i.quantity)::BIGINT AS units FROM shop_items i
    JOIN shop_orders o ON i.order_id = o.order_id JOIN shop_products p ON i.product_id = p.product_id
    WHERE o.status = 'completed' GROUP BY 1, 2, 3)"""


@query(
    "rep_revenue_by_category",
    f"{_PRODUCT_SALES} SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, sum(units)::BIGINT AS units_sold FROM sold GROUP BY category",
)
def revenue_by_category(t):
    return shop.revenue_by_category(t.shop)


@query("rep_revenue_by_month", "SELECT month, CAST(revenue AS DOUBLE) AS total_revenue, orders_count FROM months")
def revenue_by_month(t):
    return shop.revenue_by_month(t.shop)


@query(
    "rep_top_products",
    f"""{_PRODUCT_SALES} SELECT product_id, product_name, category, CAST(revenue AS DOUBLE) AS total_revenue,
        units AS total_units_sold FROM sold ORDER BY revenue DESC, product_id LIMIT 10""",
)
def top_products(t):
    return shop.top_products(t.shop)


@query(
    "rep_top_products_by_quantity",
    f"""{_PRODUCT_SALES} SELECT product_id, product_name, category, CAST(revenue AS DOUBLE) AS total_revenue,
        units AS total_units_sold FROM sold ORDER BY units DESC, product_id LIMIT 10""",
)
def top_products_by_quantity(t):
    return shop.top_products_by_quantity(t.shop)


@query(
    "rep_top_customers",
    """SELECT customer_id, name, segment, CAST(spend AS DOUBLE) AS lifetime_value, rank() OVER (ORDER BY spend DESC) AS ltv_rank
       FROM spend ORDER BY ltv_rank, customer_id LIMIT 10""",
)
def top_customers(t):
    return shop.top_customers(t.shop)


_LTV = """SELECT customer_id, name, segment, CAST(spend AS DOUBLE) AS lifetime_value,
        rank() OVER (ORDER BY spend DESC) AS ltv_rank, dense_rank() OVER (ORDER BY spend DESC) AS ltv_dense_rank,
        ntile(4) OVER (ORDER BY spend DESC, customer_id) AS ltv_quartile FROM spend"""


@query("rep_customer_ltv", f"{_LTV} ORDER BY spend DESC, customer_id LIMIT 25")
def customer_ltv(t):
    return shop.customer_ltv(t.shop)


@query("rep_customer_ltv_all", _LTV)
def customer_ltv_all(t):
    return shop.customer_ltv(t.shop, limit=None)


@query(
    "rep_aov_by_segment",
    f"""SELECT segment, sum(num_orders)::BIGINT AS num_orders, {sql_mean('sum(spend)', 'sum(num_orders)')} AS avg_order_value
        FROM spend GROUP BY segment""",
)
def aov_by_segment(t):
    return shop.aov_by_segment(t.shop)


_LAST3 = "OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@query(
    "rep_running_total",
    f"""SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(sum(revenue) OVER (ORDER BY month) AS DOUBLE) AS running_total,
        {sql_mean(f'sum(revenue) {_LAST3}', f'count(*) {_LAST3}')} AS moving_avg_3mo FROM months""",
)
def running_total(t):
    return shop.running_total(t.shop)


@query(
    "rep_growth_rate",
    f"""SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(previous AS DOUBLE) AS prev_month_revenue,
        CASE WHEN previous IS NULL OR previous = 0 THEN NULL ELSE {sql_percent('(revenue - previous)', 'previous')} END AS mom_growth_pct
        FROM (SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS previous FROM months)""",
)
def growth_rate(t):
    return shop.growth_rate(t.shop)


_SPENDING = """SELECT c.customer_id, c.name, v.order_id, v.order_date, CAST(v.value AS DOUBLE) AS order_value,
        CAST(sum(v.value) OVER (PARTITION BY c.customer_id ORDER BY v.order_date) AS DOUBLE) AS running_customer_spend
        FROM order_values v JOIN shop_customers c ON v.customer_id = c.customer_id"""


@query("rep_customer_order_history", f"{_SPENDING} ORDER BY customer_id, order_date, order_id LIMIT 50", dates=["order_date"])
def customer_order_history(t):
    return shop.customer_order_history(t.shop)


@query("rep_customer_order_history_all", _SPENDING, dates=["order_date"])
def customer_order_history_all(t):
    return shop.customer_order_history(t.shop, limit=None)


_BUYERS = """buyers AS (SELECT customer_id, date_trunc('month', min(order_date)) AS started FROM shop_orders
        WHERE status = 'completed' AND customer_id IN (SELECT customer_id FROM shop_customers) GROUP BY customer_id),
    cohorts AS (SELECT started, count(*) AS cohort_size FROM buyers GROUP BY started)"""


@query("rep_cohort_sizes", f"WITH {_BUYERS} SELECT strftime(started, '%Y-%m') AS cohort_month, cohort_size FROM cohorts")
def cohort_sizes(t):
    return shop.cohort_sizes(t.shop)


@query(
    "rep_cohort_retention",
    f"""WITH {_BUYERS} SELECT strftime(started, '%Y-%m') AS cohort_month,
            date_diff('month', started, date_trunc('month', order_date)) AS month_index,
            count(DISTINCT customer_id) AS active_customers, cohort_size,
            {sql_percent('count(DISTINCT customer_id)', 'cohort_size')} AS retention_pct
        FROM shop_orders JOIN buyers USING (customer_id) JOIN cohorts USING (started)
        WHERE status = 'completed' GROUP BY started, month_index, cohort_size""",
)
def cohort_retention(t):
    return shop.cohort_retention(t.shop)


@query(
    "rep_churn",
    """SELECT o.customer_id, count(*) AS num_orders, max(order_date) AS last_order_date,
        CASE WHEN count(*) = 1 THEN 'one-time' WHEN count(*) > 1 THEN 'repeat' END AS purchase_type,
        CASE WHEN date_diff('day', max(order_date), any_value(day)) > 180 THEN 'churned' ELSE 'active' END AS churn_status
        FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id CROSS JOIN today
        WHERE status = 'completed' GROUP BY o.customer_id""",
    dates=["last_order_date"],
)
def churn(t):
    return shop.churn(t.shop)


@query(
    "rep_frequency_segments",
    """SELECT CASE WHEN n = 1 THEN 'one-time' WHEN n BETWEEN 2 AND 4 THEN 'occasional' ELSE 'loyal' END AS frequency_segment,
        count(*) AS num_customers FROM (SELECT customer_id, count(*) AS n FROM shop_orders WHERE status = 'completed' GROUP BY 1)
        GROUP BY frequency_segment""",
)
def frequency_segments(t):
    return shop.frequency_segments(t.shop)


@query(
    "rep_spend_tiers",
    f"""SELECT CASE WHEN spend < 500000 THEN 'low' WHEN spend < 900000 THEN 'medium' ELSE 'high' END AS spend_tier,
        count(*) AS num_customers, {sql_mean('sum(spend)', 'count(*)')} AS avg_spend_in_tier FROM spend GROUP BY spend_tier""",
)
def spend_tiers(t):
    return shop.spend_tiers(t.shop, low=500000, high=900000)


_RFM = """WITH facts AS (SELECT customer_id, name, date_diff('day', last_order, day) AS recency_days,
            num_orders AS frequency, CAST(spend AS DOUBLE) AS monetary FROM spend CROSS JOIN today),
        fifths AS (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS r_score,
            ntile(5) OVER (ORDER BY frequency, customer_id) AS f_score,
            ntile(5) OVER (ORDER BY monetary, customer_id) AS m_score FROM facts),
        totals AS (SELECT *, r_score + f_score + m_score AS rfm_total FROM fifths)
        SELECT t.*, label AS rfm_segment FROM totals t JOIN (VALUES (13, 99, 'Champions'), (10, 13, 'Loyal Customers'),
            (7, 10, 'Potential Loyalists'), (4, 7, 'At Risk'), (0, 4, 'Lost')) s(low, high, label)
        ON rfm_total >= low AND rfm_total < high"""


@query("rep_rfm", _RFM)
def rfm(t):
    return shop.rfm(t.shop)


@query(
    "rep_order_status",
    f"SELECT status, count(*) AS num_orders, {sql_percent('count(*)', '(SELECT count(*) FROM shop_orders)')} AS pct_of_all_orders FROM shop_orders GROUP BY status",
)
def order_status(t):
    return shop.order_status(t.shop)


# ---- flat sales ------------------------------------------------------------------------


def _total(key: str, measure: str, tail: str = "") -> str:
    return f"SELECT {key}, CAST(sum({measure}) AS DOUBLE) AS total_{measure} FROM sales GROUP BY {key} {tail}"


@query("rep_sales_by_region", _total("region", "sales"))
def sales_by_region(t):
    return flat_sales.total_by(t.sales("geo"), "region", "sales")


@query("rep_sales_by_category", _total("category", "sales"))
def sales_by_category(t):
    return flat_sales.total_by(t.sales("product"), "category", "sales")


@query("rep_top_customer_names", _total("customer_name", "sales", "ORDER BY total_sales DESC, customer_name LIMIT 10"))
def top_customer_names(t):
    return flat_sales.top_by(t.sales("customer"), "customer_name", "sales")


@query("rep_top_product_names", _total("product_name", "sales", "ORDER BY total_sales DESC, product_name LIMIT 10"))
def top_product_names(t):
    return flat_sales.top_by(t.sales("product"), "product_name", "sales")


@query("rep_profit_by_region", _total("region", "profit"))
def profit_by_region(t):
    return flat_sales.total_by(t.sales("geo"), "region", "profit")


@query("rep_profit_by_category", _total("category", "profit"))
def profit_by_category(t):
    return flat_sales.total_by(t.sales("product"), "category", "profit")


@query("rep_largest_losses", _total("product_name", "profit", "ORDER BY total_profit, product_name LIMIT 5"))
def largest_losses(t):
    return flat_sales.bottom_by(t.sales("product"), "product_name", "profit")


_LINE = "order_id, line_no, product_id, CAST(sales AS DOUBLE) AS sales"


def _line(df, *more):
    return df.select("order_id", "line_no", "product_id", F.col("sales").cast("double").alias("sales"), *more)


@query("rep_region_rows", f"SELECT {_LINE}, region FROM sales WHERE region = 'ASIA'")
def region_rows(t):
    return _line(flat_sales.in_region(t.sales("geo"), "ASIA"), "region")


@query("rep_category_rows", f"SELECT {_LINE}, category FROM sales WHERE category = 'PROMO'")
def category_rows(t):
    return _line(flat_sales.in_category(t.sales("product"), "PROMO"), "category")


@query("rep_large_sales_rows", f"SELECT {_LINE} FROM sales WHERE sales > 90000")
def large_sales_rows(t):
    return _line(flat_sales.sales_above(t.sales(), 90000))


@query(
    "rep_monthly_trend",
    """SELECT substring(strftime(order_date, '%d-%m-%Y'), 4, 7) AS month_year, strftime(order_date, '%Y-%m') AS month,
        CAST(sum(sales) AS DOUBLE) AS total_sales FROM sales GROUP BY 1, 2""",
)
def monthly_trend(t):
    return flat_sales.monthly_trend(t.sales("order"))


@query("rep_repeated_orders", "SELECT order_id, count(*) AS duplicate_count FROM sales GROUP BY order_id HAVING count(*) > 1")
def repeated_orders(t):
    return flat_sales.repeated_orders(t.sales())


# ---- customer questions ----------------------------------------------------------------

_TOTALS = "WITH totals AS (SELECT customer_id, sum(sales) AS total_sales FROM sales GROUP BY customer_id)"
_TOTAL = "CAST(total_sales AS DOUBLE) AS total_sales"


def _double_total(df):
    return df.withColumn("total_sales", F.col("total_sales").cast("double"))


@query("rep_lines_above_average", f"SELECT {_LINE} FROM sales WHERE sales > (SELECT sum(sales) / count(*) FROM sales)")
def lines_above_average(t):
    return _line(customer_sales.above_average_lines(t.sales()))


@query("rep_highest_line", "SELECT customer_id, CAST(max(sales) AS DOUBLE) AS highest_order_value FROM sales GROUP BY customer_id")
def highest_line(t):
    best = customer_sales.highest_line(t.sales("order"))
    return best.withColumn("highest_order_value", F.col("highest_order_value").cast("double"))


@query("rep_total_per_customer", f"{_TOTALS} SELECT customer_id, {_TOTAL} FROM totals")
def total_per_customer(t):
    return _double_total(customer_sales.total_sales(t.sales("order")))


@query("rep_customers_above_average", f"{_TOTALS} SELECT customer_id, {_TOTAL} FROM totals WHERE total_sales > (SELECT avg(total_sales) FROM totals)")
def customers_above_average(t):
    return _double_total(customer_sales.above_average_customers(t.sales("order")))


@query("rep_customer_rank", f"{_TOTALS} SELECT customer_id, {_TOTAL}, rank() OVER (ORDER BY totals.total_sales DESC) AS customer_rank FROM totals")
def customer_rank(t):
    return _double_total(customer_sales.ranked(t.sales("order")))


@query(
    "rep_numbered_lines",
    """SELECT customer_id, order_id, CAST(sales AS DOUBLE) AS sales, row_number() OVER (PARTITION BY customer_id
        ORDER BY sales.sales DESC, order_id, line_no, product_id, store_id, ship_date) AS row_num FROM sales""",
)
def numbered_lines(t):
    lines = t.sales("order").select("customer_id", "order_id", "sales", "line_no", "product_id", "store_id", "ship_date")
    numbered = customer_sales.numbered_lines(lines, ["order_id", "line_no", "product_id", "store_id", "ship_date"])
    return numbered.select("customer_id", "order_id", F.col("sales").cast("double").alias("sales"), "row_num")


@query(
    "rep_top3_customers",
    f"""{_TOTALS} SELECT customer_id, CAST(total_sales AS DOUBLE) AS total_sales, customer_rank
        FROM (SELECT *, rank() OVER (ORDER BY total_sales DESC) AS customer_rank FROM totals) WHERE customer_rank <= 3""",
)
def top3_customers(t):
    return _double_total(customer_sales.top_ranked(t.sales("order")))


@query(
    "rep_customer_names_ranked",
    f"""{_TOTALS} SELECT c.name AS customer_name, CAST(s.total_sales AS DOUBLE) AS total_sales,
        rank() OVER (ORDER BY s.total_sales DESC) AS customer_rank
        FROM totals s JOIN shop_customers c ON s.customer_id = c.customer_id""",
)
def customer_names_ranked(t):
    names = t.customers.withColumnRenamed("name", "customer_name")
    return _double_total(customer_sales.ranked_names(t.sales("order"), names))


@query("rep_top5_customers", f"{_TOTALS} SELECT customer_id, {_TOTAL} FROM totals ORDER BY totals.total_sales DESC, customer_id LIMIT 5")
def top5_customers(t):
    return _double_total(customer_sales.top(t.sales("order")))


@query("rep_bottom5_customers", f"{_TOTALS} SELECT customer_id, {_TOTAL} FROM totals ORDER BY totals.total_sales, customer_id LIMIT 5")
def bottom5_customers(t):
    return _double_total(customer_sales.bottom(t.sales("order")))


@query("rep_single_order_customers", "SELECT customer_id, count(DISTINCT order_id) AS total_orders FROM sales GROUP BY customer_id HAVING count(DISTINCT order_id) = 1")
def single_order_customers(t):
    return customer_sales.single_order(t.sales("order"))


# ---- first shop: filters, aggregates, joins --------------------------------------------


@query("rep_shop_delivered", "SELECT order_id, customer_id, order_date FROM shop_orders WHERE status = 'completed'", dates=["order_date"])
def shop_delivered(t):
    return t.orders.filter(F.col("status") == "completed").select("order_id", "customer_id", "order_date")


@query("rep_shop_category_price", "SELECT product_id, category, brand FROM shop_products WHERE category = 'PROMO' AND unit_price > 950")
def shop_category_price(t):
    rows = t.products.filter((F.col("category") == "PROMO") & (F.col("unit_price") > 950))
    return rows.select("product_id", "category", "brand")


@query(
    "rep_shop_country_year",
    """SELECT o.order_id, c.customer_id, g.country FROM shop_orders o JOIN shop_customers c USING (customer_id)
       JOIN geography g USING (nation_id) WHERE g.country = 'NATION_7' AND year(o.order_date) = 1997""",
)
def shop_country_year(t):
    day = F.col("order_date")
    orders = t.orders.filter((day >= F.lit("1997-01-01").cast("date")) & (day < F.lit("1998-01-01").cast("date")))
    buyers = t.customers.join(t.geography.filter(F.col("country") == "NATION_7"), "nation_id")
    return orders.join(buyers, "customer_id").select("order_id", "customer_id", "country")


@query(
    "rep_shop_period_open",
    "SELECT order_id, order_date, status FROM shop_orders WHERE order_date BETWEEN DATE '1998-08-10' AND DATE '1998-08-25' AND status <> 'cancelled'",
    dates=["order_date"],
)
def shop_period_open(t):
    in_period = F.col("order_date").between(F.lit("1998-08-10").cast("date"), F.lit("1998-08-25").cast("date"))
    return t.orders.filter(in_period & (F.col("status") != "cancelled")).select("order_id", "order_date", "status")


@query("rep_shop_month_orders", "SELECT order_id, order_date FROM shop_orders WHERE order_date BETWEEN DATE '1998-08-01' AND DATE '1998-08-31'", dates=["order_date"])
def shop_month_orders(t):
    in_month = F.col("order_date").between(F.lit("1998-08-01").cast("date"), F.lit("1998-08-31").cast("date"))
    return t.orders.filter(in_month).select("order_id", "order_date")


@query("rep_shop_year_orders", "SELECT order_id FROM shop_orders WHERE year(order_date) = 1998")
def shop_year_orders(t):
    day = F.col("order_date")
    in_year = (day >= F.lit("1998-01-01").cast("date")) & (day < F.lit("1999-01-01").cast("date"))
    return t.orders.filter(in_year).select("order_id")


@query("rep_shop_order_count", "SELECT count(*) AS total_orders FROM shop_orders")
def shop_order_count(t):
    return t.orders.agg(F.count("*").alias("total_orders"))


@query("rep_shop_delivered_revenue", "SELECT CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM shop_orders WHERE status = 'completed'")
def shop_delivered_revenue(t):
    return t.orders.filter(F.col("status") == "completed").agg(money.total("total_amount").alias("total_revenue"))


@query("rep_shop_average_price", f"SELECT category, {sql_mean('sum(unit_price)', 'count(*)')} AS average_price FROM shop_products GROUP BY category")
def shop_average_price(t):
    return t.products.groupBy("category").agg(money.mean(F.sum("unit_price"), F.count("*")).alias("average_price"))


@query("rep_shop_status_revenue", "SELECT status, count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM shop_orders GROUP BY status")
def shop_status_revenue(t):
    groups = t.orders.groupBy("status").agg(
        F.count("*").alias("total_orders"), money.total("total_amount").alias("total_revenue")
    )
    return groups.orderBy(F.desc("total_revenue"))


@query(
    "rep_shop_price_range",
    "SELECT category, CAST(max(unit_price) AS DOUBLE) AS highest_price, CAST(min(unit_price) AS DOUBLE) AS lowest_price FROM shop_products GROUP BY category",
)
def shop_price_range(t):
    return t.products.groupBy("category").agg(
        F.max("unit_price").cast("double").alias("highest_price"),
        F.min("unit_price").cast("double").alias("lowest_price"),
    )


@query(
    "rep_shop_expensive_categories",
    f"SELECT category, {sql_mean('sum(unit_price)', 'count(*)')} AS average_price FROM shop_products GROUP BY category HAVING sum(unit_price) > 950 * count(*)",
)
def shop_expensive_categories(t):
    groups = t.products.groupBy("category").agg(F.sum("unit_price").alias("_sum"), F.count("*").alias("_n"))
    above = groups.filter(F.col("_sum") > 950 * F.col("_n"))
    return above.select("category", money.mean(F.col("_sum"), F.col("_n")).alias("average_price"))


@query(
    "rep_shop_orders_with_names",
    """SELECT o.order_id, o.order_date, c.name, CAST(o.total_amount AS DOUBLE) AS total_amount
       FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id""",
    dates=["order_date"],
)
def shop_orders_with_names(t):
    rows = t.orders.join(t.customers, "customer_id")
    return rows.select("order_id", "order_date", "name", F.col("total_amount").cast("double").alias("total_amount"))


@query(
    "rep_shop_customers_with_orders",
    "SELECT c.customer_id, c.name, o.order_id, o.order_date FROM shop_customers c LEFT JOIN shop_orders o ON c.customer_id = o.customer_id",
    dates=["order_date"],
)
def shop_customers_with_orders(t):
    orders = t.orders.select("customer_id", "order_id", "order_date")
    return joins.keep_all_parents(t.customers.select("customer_id", "name"), orders, "customer_id")


@query(
    "rep_shop_order_lines",
    """SELECT o.order_id, p.product_name, i.quantity, CAST(p.unit_price AS DOUBLE) AS unit_price, CAST(i.discount AS DOUBLE) AS discount
       FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id JOIN shop_products p ON i.product_id = p.product_id""",
)
def shop_order_lines(t):
    rows = t.items.join(t.orders.select("order_id"), "order_id").join(t.products, "product_id")
    return rows.select(
        "order_id",
        "product_name",
        "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount").cast("double").alias("discount"),
    )


_STAR = """c.customer_id AS buyer_id, c.name, c.segment, c.nation_id, CAST(c.balance AS DOUBLE) AS balance, o.order_id,
    o.customer_id, o.order_date, o.status, CAST(o.total_amount AS DOUBLE) AS total_amount, o.priority"""


def _star(t):
    buyers = t.customers.withColumn("balance", F.col("balance").cast("double"))
    orders = t.orders.withColumn("total_amount", F.col("total_amount").cast("double"))
    return buyers.withColumn("buyer_id", F.col("customer_id")), orders


@query("rep_shop_left_star", f"SELECT {_STAR} FROM shop_customers c LEFT JOIN shop_orders o ON c.customer_id = o.customer_id", dates=["order_date"])
def shop_left_star(t):
    buyers, orders = _star(t)
    joined = joins.keep_all_parents(buyers, orders, "customer_id")
    matched = F.col("order_id").isNotNull()
    return joined.withColumn("customer_id", F.when(matched, F.col("customer_id")))


@query("rep_shop_right_star", f"SELECT {_STAR} FROM shop_customers c RIGHT JOIN shop_orders o ON c.customer_id = o.customer_id", dates=["order_date"])
def shop_right_star(t):
    buyers, orders = _star(t)
    return buyers.join(orders, "customer_id", "right")


@query(
    "rep_shop_price_tiers",
    """SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price, CASE WHEN unit_price < 930 THEN 'Budget'
       WHEN unit_price BETWEEN 930 AND 960 THEN 'Mid-Range' ELSE 'Premium' END AS price_tier FROM shop_products""",
)
def shop_price_tiers(t):
    price = F.col("unit_price")
    tier = F.when(price < 930, "Budget").when(price.between(930, 960), "Mid-Range").otherwise("Premium")
    return t.products.select("product_name", price.cast("double").alias("unit_price"), tier.alias("price_tier"))


@query(
    "rep_shop_delivered_or_not",
    """SELECT count(*) FILTER (status = 'completed') AS delivered_orders,
       count(*) FILTER (status <> 'completed') AS not_delivered_orders FROM shop_orders""",
)
def shop_delivered_or_not(t):
    done = F.col("status") == "completed"
    return t.orders.agg(
        F.count_if(done).alias("delivered_orders"), F.count_if(~done).alias("not_delivered_orders")
    )


# ---- retail transactions ---------------------------------------------------------------


@query("rep_retail_premium_young", "SELECT user_id, age, subscription, city FROM retail WHERE age BETWEEN 18 AND 30 AND subscription = 'Premium'")
def retail_premium_young(t):
    return retail.premium_by_age(t.retail).select("user_id", "age", "subscription", "city")


_SALE = "CAST(sale_amount AS DOUBLE) AS sale_amount"


def _sale():
    return F.col("sale_amount").cast("double").alias("sale_amount")


@query("rep_retail_region", f"SELECT user_id, region, product_category, {_SALE} FROM retail WHERE region = 'EUROPE'")
def retail_region(t):
    return retail.in_region(t.retail, "EUROPE").select("user_id", "region", "product_category", _sale())


@query(
    "rep_retail_large_sales",
    f"SELECT user_id, product_category, {_SALE}, region FROM retail WHERE product_category = 'LARGE' AND retail.sale_amount > 80000",
)
def retail_large_sales(t):
    rows = retail.large_sales(t.retail, "LARGE", above=80000)
    return rows.select("user_id", "product_category", _sale(), "region")


@query(
    "rep_retail_price_stats",
    f"""SELECT count(price) AS count, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
        {sql_mean('sum(price)', 'count(price)')} AS avg_price, CAST(sum(price) AS DOUBLE) AS total_price FROM retail""",
)
def retail_price_stats(t):
    return retail.price_statistics(t.retail)


@query(
    "rep_retail_region_stats",
    f"""SELECT region, count(sale_amount) AS num_transactions, CAST(sum(sale_amount) AS DOUBLE) AS total_sales,
        {sql_mean('sum(sale_amount)', 'count(sale_amount)')} AS avg_sale, CAST(min(sale_amount) AS DOUBLE) AS min_sale,
        CAST(max(sale_amount) AS DOUBLE) AS max_sale FROM retail GROUP BY region""",
)
def retail_region_stats(t):
    return retail.sales_by_region(t.retail)


@query("rep_retail_busy_cities", "SELECT city, count(*) AS record_count FROM retail GROUP BY city HAVING count(*) > 2000")
def retail_busy_cities(t):
    return retail.busy_cities(t.retail, more_than=2000)


@query(
    "rep_retail_category_average",
    f"SELECT product_category, {sql_mean('sum(sale_amount)', 'count(sale_amount)')} AS avg_sale_amount FROM retail WHERE region = 'EUROPE' GROUP BY product_category",
)
def retail_category_average(t):
    return retail.category_average(t.retail, "EUROPE")


@query(
    "rep_retail_handled",
    """SELECT subscription, status, age, count(*) AS n FROM (
         SELECT coalesce(subscription, 'Basic') AS subscription, coalesce(status, 'Unknown') AS status, coalesce(age, 0) AS age
         FROM retail WHERE email IS NOT NULL AND trim(username) <> '') GROUP BY 1, 2, 3""",
)
def retail_handled(t):
    return retail.handled(t.retail).groupBy("subscription", "status", "age").agg(F.count("*").alias("n"))


_STORES = f"""SELECT store_id, CAST(sum(coalesce(revenue, 0)) AS DOUBLE) AS total_revenue, count(*) AS transaction_count,
        {sql_mean('sum(coalesce(price, 0))', 'count(*)')} AS avg_price
        FROM (SELECT DISTINCT * FROM retail_with_copies) WHERE email IS NOT NULL AND trim(username) <> '' GROUP BY store_id"""


@query("rep_retail_store_revenue", _STORES)
def retail_store_revenue(t):
    return retail.store_revenue(t.retail_with_copies)


@query(
    "rep_retail_step_counts",
    """WITH once AS (SELECT DISTINCT * FROM retail_with_copies),
            reached AS (SELECT * FROM once WHERE email IS NOT NULL AND trim(username, ' ') <> '')
       SELECT (SELECT count(*) FROM retail_with_copies) AS raw_rows, (SELECT count(*) FROM once) AS distinct_rows,
              (SELECT count(*) FROM reached) AS clean_rows, (SELECT count(DISTINCT store_id) FROM reached) AS stores""",
)
def retail_step_counts(t):
    return retail.step_counts(t.retail_with_copies)


# ---- order book ------------------------------------------------------------------------

_BOOK = """order_id, user_id, product_id, category, product_name AS item_name, base_price,
    TRY_CAST(price AS DOUBLE) AS price, amount, quantity, region, priority, status, order_date"""


@query("rep_orders_typed", f"SELECT {_BOOK} FROM order_book")
def orders_typed(t):
    return order_book.typed(t.order_book)


@query("rep_orders_with_tax", f"SELECT {_BOOK}, base_price * CAST(1.18 AS DOUBLE) AS final_price FROM order_book")
def orders_with_tax(t):
    return order_book.with_tax(order_book.typed(t.order_book))


@query("rep_orders_in_category", f"SELECT {_BOOK} FROM order_book WHERE category = 'ECONOMY'")
def orders_in_category(t):
    return order_book.in_category(order_book.typed(t.order_book), "ECONOMY")


@query("rep_orders_completed_large", f"SELECT {_BOOK} FROM order_book WHERE status = 'completed' AND amount > 80000")
def orders_completed_large(t):
    return order_book.large_with_status(order_book.typed(t.order_book), "completed", above=80000)


@query("rep_orders_region_or_priority", f"SELECT {_BOOK} FROM order_book WHERE region = 'ASIA' OR priority = '2-HIGH'")
def orders_region_or_priority(t):
    return order_book.region_or_priority(order_book.typed(t.order_book), "ASIA", "2-HIGH")


@query("rep_orders_per_category", "SELECT category, count(*) AS count FROM order_book GROUP BY category")
def orders_per_category(t):
    return order_book.rows_per_category(t.order_book)


@query(
    "rep_orders_final_export",
    f"SELECT {_BOOK}, base_price * CAST(1.18 AS DOUBLE) AS final_price FROM order_book WHERE user_id IS NOT NULL",
)
def orders_final_export(t):
    return order_book.final_export(order_book.with_tax(order_book.typed(t.order_book)), new_path(t.spark, "export"))


# ---- offers ----------------------------------------------------------------------------

_OFFER = "offer_id, title, rating, discount, initial_price"


def _offer(df):
    return df.select("offer_id", "title", "rating", "discount", "initial_price")


@query("rep_deals_well_rated", f"SELECT {_OFFER} FROM offers WHERE rating > 4.5")
def deals_well_rated(t):
    return _offer(t.offers.filter(deals.well_rated()))


@query("rep_deals_discounted", f"SELECT {_OFFER} FROM offers WHERE discount > 65")
def deals_discounted(t):
    return _offer(t.offers.filter(deals.heavily_discounted()))


@query("rep_deals_premium", f"SELECT {_OFFER} FROM offers WHERE initial_price > 7000")
def deals_premium(t):
    return _offer(t.offers.filter(deals.premium()))


@query("rep_deals_best", f"SELECT {_OFFER} FROM offers WHERE rating > 4.5 AND discount > 65")
def deals_best(t):
    return _offer(t.offers.filter(deals.best_deal()))


@query(
    "rep_deals_counts",
    """SELECT count(*) FILTER (rating > 4.5) AS highly_rated, count(*) FILTER (discount > 65) AS highly_discounted,
       count(*) FILTER (initial_price > 7000) AS premium_products, count(*) FILTER (rating > 4.5 AND discount > 65) AS best_deals
       FROM offers""",
)
def deals_counts(t):
    return deals.deal_counts(t.offers)


def _mode(column: str) -> str:
    return f"(SELECT {column} FROM offers WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(
    "rep_deals_cleaned",
    f"""SELECT offer_id, title, rating, discount, initial_price, final_price, delivery_options, seller_name, seller_information,
        initial_price - initial_price * discount / 100 AS total_amount
        FROM (SELECT * REPLACE (coalesce(discount, (SELECT median(discount) FROM offers)) AS discount,
            coalesce(seller_name, {_mode('seller_name')}) AS seller_name,
            coalesce(seller_information, {_mode('seller_information')}) AS seller_information) FROM offers)""",
)
def deals_cleaned(t):
    return deals.cleaned(t.offers)
