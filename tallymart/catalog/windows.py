"""Window functions, over groups and over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.catalog.registry import query
from tallymart.catalog.tables import sql_mean
from tallymart.functions import money
from tallymart.operators import ranking, scans
from tallymart.plans import shop as reports
from tallymart.session import materialise

_TOTALS = "WITH totals AS (SELECT customer_id, CAST(sum(total_amount) AS DOUBLE) AS total FROM shop_orders GROUP BY 1)"


def _totals(t):
    return materialise(t.orders.groupBy("customer_id").agg(money.total("total_amount").alias("total")))


@query("win_rank", f"{_TOTALS} SELECT customer_id, total, rank() OVER (ORDER BY total DESC) AS rank FROM totals")
def win_rank(t):
    return ranking.rank(_totals(t), ["-total"], "rank")


@query("win_dense_rank", "SELECT order_id, order_date, rank() OVER (ORDER BY order_date) AS rank, dense_rank() OVER (ORDER BY order_date) AS dense_rank FROM shop_orders", dates=["order_date"])
def win_dense_rank(t):
    return ranking.rank(t.orders.select("order_id", "order_date"), ["order_date"], "rank", "dense_rank")


@query("win_ntile4", f"{_TOTALS} SELECT customer_id, total, ntile(4) OVER (ORDER BY total DESC, customer_id) AS quartile FROM totals")
def win_ntile4(t):
    return ranking.ntile(_totals(t), 4, ["-total", "customer_id"], "quartile")


@query(
    "win_ntile5",
    """SELECT order_id, ntile(5) OVER (ORDER BY priority, order_id) AS by_priority,
              ntile(5) OVER (ORDER BY order_date DESC, order_id) AS by_recency FROM shop_orders""",
)
def win_ntile5(t):
    rows = t.orders.select("order_id", "priority", "order_date")
    buckets = {"by_priority": (5, ["priority", "order_id"]), "by_recency": (5, ["-order_date", "order_id"])}
    return ranking.ntiles(rows, buckets).drop("priority", "order_date")


@query(
    "win_row_number",
    """SELECT customer_id, order_id, CAST(total_amount AS DOUBLE) AS total_amount,
              row_number() OVER (PARTITION BY customer_id ORDER BY total_amount DESC, order_id) AS row_num FROM shop_orders""",
)
def win_row_number(t):
    rows = t.orders.select("customer_id", "order_id", F.col("total_amount").cast("double").alias("total_amount"))
    return ranking.row_number_by(rows, ["customer_id"], ["-total_amount", "order_id"])


@query("win_row_number_global", "SELECT order_id, row_number() OVER (ORDER BY status, total_amount DESC, order_id) AS row_num FROM shop_orders")
def win_row_number_global(t):
    rows = t.orders.select("order_id", "status", "total_amount")
    return ranking.row_number(rows, ["status", "-total_amount", "order_id"]).drop("status", "total_amount")


@query("win_lag", "SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(lag(revenue) OVER (ORDER BY month) AS DOUBLE) AS previous FROM months")
def win_lag(t):
    # months are few whatever the number of orders
    previous = F.lag("revenue").over(Window.orderBy("month"))
    return reports.monthly_revenue(t.shop).select(
        "month", money.to_double("revenue").alias("revenue"), money.to_double(previous).alias("previous")
    )


@query("win_running", "SELECT order_date, CAST(sum(sum(total_amount)) OVER (ORDER BY order_date) AS DOUBLE) AS running_total FROM shop_orders GROUP BY order_date", dates=["order_date"])
def win_running(t):
    # one row per day reaches the window
    days = t.orders.groupBy("order_date").agg(F.sum("total_amount").alias("_day"))
    running = F.sum("_day").over(Window.orderBy("order_date")).cast("double")
    return days.select("order_date", running.alias("running_total"))


_LAST3 = "OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@query("win_moving", f"SELECT month, {sql_mean(f'sum(revenue) {_LAST3}', f'count(*) {_LAST3}')} AS moving_avg FROM months")
def win_moving(t):
    last3 = Window.orderBy("month").rowsBetween(-2, Window.currentRow)
    average = money.mean(F.sum("revenue").over(last3), F.count("*").over(last3))
    return reports.monthly_revenue(t.shop).select("month", average.alias("moving_avg"))


@query(
    "win_running_part",
    """SELECT order_id, customer_id, order_date,
              CAST(sum(total_amount) OVER (PARTITION BY customer_id ORDER BY order_date) AS DOUBLE) AS running_spend FROM shop_orders""",
    dates=["order_date"],
)
def win_running_part(t):
    # summed per day first: a customer's window is no longer than the calendar
    days = t.orders.groupBy("customer_id", "order_date").agg(F.sum("total_amount").alias("_day"))
    running = days.select(
        "customer_id",
        "order_date",
        F.sum("_day").over(Window.partitionBy("customer_id").orderBy("order_date")).cast("double").alias("running_spend"),
    )
    return t.orders.select("order_id", "customer_id", "order_date").join(running, ["customer_id", "order_date"])


@query(
    "win_top_rank",
    "SELECT * FROM (SELECT order_id, order_date, rank() OVER (ORDER BY order_date DESC) AS rank FROM shop_orders) WHERE rank <= 3",
    dates=["order_date"],
)
def win_top_rank(t):
    return ranking.top_ranked(t.orders.select("order_id", "order_date"), 3, ["-order_date"])


@query(
    "win_rank_distributed",
    """SELECT order_id, line_no, product_id, CAST(line_total AS DOUBLE) AS line_total,
              rank() OVER (ORDER BY quantity DESC, line_total) AS rank,
              dense_rank() OVER (ORDER BY quantity DESC, line_total) AS dense_rank FROM shop_items""",
)
def win_rank_distributed(t):
    rows = t.items.select("order_id", "line_no", "product_id", "quantity", "line_total")
    ranked = ranking.rank(rows, ["-quantity", "line_total"], "rank", "dense_rank").drop("quantity")
    return ranked.withColumn("line_total", F.col("line_total").cast("double"))


_LINE_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_EXACT = "CAST(l_extendedprice AS DECIMAL(18,2))"


def _lines(t):
    """All order lines with an order that only equal rows tie in."""
    rows = t.raw("lineitem").withColumn("amount", F.col("l_extendedprice").cast("decimal(18,2)"))
    return rows, _LINE_ORDER.split(", ")


@query(
    "win_lag_distributed",
    f"""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS shipped, CAST(amount AS DOUBLE) AS amount,
               CAST(lag(amount) OVER w AS DOUBLE) AS previous, CAST(lag(amount, 7) OVER w AS DOUBLE) AS seventh
        FROM (SELECT *, {_EXACT} AS amount FROM lineitem) WINDOW w AS (ORDER BY {_LINE_ORDER})""",
)
def win_lag_distributed(t):
    rows, order = _lines(t)
    found = scans.scan(rows, order, lags={"previous": ("amount", 1), "seventh": ("amount", 7)})
    values = [F.col(c).cast("double").alias(c) for c in ("amount", "previous", "seventh")]
    return found.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"), *values)


@query(
    "win_running_distributed",
    f"""SELECT l_orderkey, l_linenumber, row_number() OVER w AS place, CAST(sum(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
               CAST(sum(amount) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_ten
        FROM (SELECT *, {_EXACT} AS amount FROM lineitem) WINDOW w AS (ORDER BY {_LINE_ORDER})""",
)
def win_running_distributed(t):
    rows, order = _lines(t)
    found = scans.scan(rows, order, number="place", running={"running_total": "amount"}, moving={"last_ten": ("amount", 10)})
    return found.select("l_orderkey", "l_linenumber", "place", *[F.col(c).cast("double").alias(c) for c in ("running_total", "last_ten")])


@query(
    "win_running_by_group",
    f"""SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER w AS place, CAST(sum(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
               CAST(sum(amount) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_three, CAST(lag(amount, 2) OVER w AS DOUBLE) AS second
        FROM (SELECT *, {_EXACT} AS amount FROM lineitem) WINDOW w AS (PARTITION BY l_returnflag ORDER BY {_LINE_ORDER})""",
)
def win_running_by_group(t):
    # three groups hold all lines
    rows, order = _lines(t)
    found = scans.scan(rows, order, ["l_returnflag"], number="place", running={"running_total": "amount"}, lags={"second": ("amount", 2)}, moving={"last_three": ("amount", 3)})
    return found.select("l_orderkey", "l_linenumber", "l_returnflag", "place", *[F.col(c).cast("double").alias(c) for c in ("running_total", "last_three", "second")])
