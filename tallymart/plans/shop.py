"""Named reports over customers, products, orders and order items.

Revenue comes from the items of completed orders. Items are summed per order (or product)
before they meet another table, so the joins are on unique keys and a hot order, customer
or product has shrunk to one row by then. Money columns are decimals on the way in.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import money as m
from tallymart.functions.dates import month_label, month_number
from tallymart.operators import ranking
from tallymart.session import materialise


class Shop(NamedTuple):
    customers: DataFrame  # customer_id, name, segment
    products: DataFrame  # product_id, product_name, category
    orders: DataFrame  # order_id, customer_id, order_date, status
    items: DataFrame  # order_id, product_id, quantity, line_total
    values: DataFrame | None = None  # stored order values, see with_order_values


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def completed_orders(shop: Shop) -> DataFrame:
    return shop.orders.filter(F.col("status") == "completed")


def order_values(shop: Shop) -> DataFrame:
    """One row per completed order with items: order_id, customer_id, order_date, value."""
    if shop.values is not None:
        return shop.values
    values = shop.items.groupBy("order_id").agg(F.sum("line_total").alias("value"))
    return completed_orders(shop).select("order_id", "customer_id", "order_date").join(values, "order_id")


def with_order_values(shop: Shop) -> Shop:
    """``shop`` with its order values stored: most reports start from them, so a run of several
    reports sums the items and joins them to the orders once."""
    return shop._replace(values=materialise(order_values(shop), "order-values"))


def customer_spend(shop: Shop) -> DataFrame:
    """Per customer: exact spend, number of orders, last order date."""
    spend = (
        order_values(shop)
        .groupBy("customer_id")
        .agg(F.sum("value").alias("spend"), F.count("*").alias("num_orders"), F.max("order_date").alias("last_order"))
    )
    return shop.customers.join(spend, "customer_id")


def product_sales(shop: Shop) -> DataFrame:
    """Per product: exact revenue and units from completed orders."""
    sold = (
        shop.items.join(completed_orders(shop).select("order_id"), "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units"))
    )
    return shop.products.join(sold, "product_id")


def monthly_revenue(shop: Shop) -> DataFrame:
    """One row per calendar month that has a completed order."""
    return (
        order_values(shop)
        .groupBy(month_label(F.col("order_date")).alias("month"))
        .agg(F.sum("value").alias("revenue"), F.count("*").alias("orders_count"))
    )


# ---- revenue ---------------------------------------------------------------------------


def revenue_by_customer(shop: Shop, limit: int | None = None) -> DataFrame:
    result = customer_spend(shop).select(
        "customer_id",
        "name",
        "segment",
        m.to_double("spend").alias("total_revenue"),
        F.col("num_orders").alias("total_orders"),
    )
    return _limited(result.orderBy(F.desc("total_revenue"), "customer_id"), limit)


def revenue_by_category(shop: Shop) -> DataFrame:
    return (
        product_sales(shop)
        .groupBy("category")
        .agg(m.to_double(F.sum("revenue")).alias("total_revenue"), F.sum("units").alias("units_sold"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def revenue_by_month(shop: Shop) -> DataFrame:
    return (
        monthly_revenue(shop)
        .select("month", m.to_double("revenue").alias("total_revenue"), "orders_count")
        .orderBy("month")
    )


def _products(shop: Shop) -> DataFrame:
    return product_sales(shop).select(
        "product_id",
        "product_name",
        "category",
        m.to_double("revenue").alias("total_revenue"),
        F.col("units").alias("total_units_sold"),
    )


def top_products(shop: Shop, limit: int | None = 10) -> DataFrame:
    return _limited(_products(shop).orderBy(F.desc("total_revenue"), "product_id"), limit)


def top_products_by_quantity(shop: Shop, limit: int | None = 10) -> DataFrame:
    return _limited(_products(shop).orderBy(F.desc("total_units_sold"), "product_id"), limit)


# ---- customers -------------------------------------------------------------------------

_BY_VALUE = ["-lifetime_value", "customer_id"]


def _lifetime(shop: Shop) -> DataFrame:
    return customer_spend(shop).select(
        "customer_id", "name", "segment", m.to_double("spend").alias("lifetime_value")
    )


def top_customers(shop: Shop, limit: int | None = 10) -> DataFrame:
    """Customers with RANK by lifetime value. The rank of a top row only depends on rows above it,
    so a limited report ranks its own rows only; the whole one is ranked across tasks."""
    if limit is None:
        ranked = ranking.rank(materialise(_lifetime(shop)), ["-lifetime_value"], "ltv_rank")
    else:
        top = _lifetime(shop).orderBy(*ranking.sort_keys(_BY_VALUE)).limit(limit)
        ranked = top.withColumn("ltv_rank", F.rank().over(Window.orderBy(F.desc("lifetime_value"))).cast("long"))
    return ranked.orderBy("ltv_rank", "customer_id")


def customer_ltv(shop: Shop, limit: int | None = 25) -> DataFrame:
    """Rank, dense rank and quartile (1 = top spenders) by lifetime value."""
    customers = materialise(_lifetime(shop))
    if limit is None:
        ranked = ranking.rank(customers, ["-lifetime_value"], "ltv_rank", "ltv_dense_rank")
        scored = ranking.ntile(ranked, 4, _BY_VALUE, "ltv_quartile")
    else:
        by_value = Window.orderBy(F.desc("lifetime_value"))
        place = F.row_number().over(Window.orderBy(*ranking.sort_keys(_BY_VALUE)))
        rows = customers.agg(F.count("*")).scalar()
        scored = (
            customers.orderBy(*ranking.sort_keys(_BY_VALUE))
            .limit(limit)
            .withColumn("ltv_rank", F.rank().over(by_value).cast("long"))
            .withColumn("ltv_dense_rank", F.dense_rank().over(by_value).cast("long"))
            .withColumn("ltv_quartile", ranking.bucket_of(place, rows, 4))
        )
    return scored.orderBy(*ranking.sort_keys(_BY_VALUE))


def aov_by_segment(shop: Shop) -> DataFrame:
    return (
        customer_spend(shop)
        .groupBy("segment")
        .agg(F.sum("num_orders").alias("num_orders"), F.sum("spend").alias("_spend"))
        .select("segment", "num_orders", m.mean(F.col("_spend"), F.col("num_orders")).alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"), "segment")
    )


def customer_order_history(shop: Shop, limit: int | None = 50) -> DataFrame:
    """Orders with the running spend of their customer; orders of one day share the value.

    The running sum is taken over days, so a customer's window is no longer than the calendar.
    """
    values = order_values(shop)
    days = values.groupBy("customer_id", "order_date").agg(F.sum("value").alias("_day"))
    running = days.withColumn(
        "_running", F.sum("_day").over(Window.partitionBy("customer_id").orderBy("order_date"))
    ).drop("_day")
    result = (
        values.join(running, ["customer_id", "order_date"])
        .join(shop.customers.select("customer_id", "name"), "customer_id")
        .select(
            "customer_id",
            "name",
            "order_id",
            "order_date",
            m.to_double("value").alias("order_value"),
            m.to_double("_running").alias("running_customer_spend"),
        )
    )
    return _limited(result.orderBy("customer_id", "order_date", "order_id"), limit)


# ---- time: windows over months, at most twelve rows a year -----------------------------


def running_total(shop: Shop) -> DataFrame:
    by_month = Window.orderBy("month")
    last_three = by_month.rowsBetween(-2, Window.currentRow)
    return (
        monthly_revenue(shop)
        .select(
            "month",
            m.to_double("revenue").alias("revenue"),
            m.to_double(F.sum("revenue").over(by_month)).alias("running_total"),
            m.mean(F.sum("revenue").over(last_three), F.count("*").over(last_three)).alias("moving_avg_3mo"),
        )
        .orderBy("month")
    )


def growth_rate(shop: Shop) -> DataFrame:
    """Growth against the previous month that has revenue; gaps are not filled."""
    months = monthly_revenue(shop).withColumn("_prev", F.lag("revenue").over(Window.orderBy("month")))
    return months.select(
        "month",
        m.to_double("revenue").alias("revenue"),
        m.to_double("_prev").alias("prev_month_revenue"),
        F.when(F.col("_prev").isNull() | (F.col("_prev") == 0), None)
        .otherwise(m.percent(F.col("revenue") - F.col("_prev"), F.col("_prev")))
        .alias("mom_growth_pct"),
    ).orderBy("month")


# ---- cohorts and segments --------------------------------------------------------------


def _active_months(shop: Shop) -> DataFrame:
    """Distinct (customer, month) of completed orders, with the customer's first month."""
    months = (
        completed_orders(shop)
        .select("customer_id", F.trunc("order_date", "month").alias("_month"))
        .distinct()
        .join(shop.customers.select("customer_id"), "customer_id", "left_semi")
    )
    return months.withColumn("_first", F.min("_month").over(Window.partitionBy("customer_id")))


def cohort_sizes(shop: Shop) -> DataFrame:
    first = (
        completed_orders(shop)
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("_first"))
        .join(shop.customers.select("customer_id"), "customer_id", "left_semi")
    )
    return (
        first.groupBy(month_label(F.col("_first")).alias("cohort_month"))
        .agg(F.count("*").alias("cohort_size"))
        .orderBy("cohort_month")
    )


def cohort_retention(shop: Shop) -> DataFrame:
    """Customers of a cohort (month of the first completed order) active N months later.

    All customers of a cohort are active in month 0, so its count is the cohort's size.
    """
    index = (month_number(F.col("_month")) - month_number(F.col("_first"))).cast("long")
    active = (
        _active_months(shop)
        .groupBy(month_label(F.col("_first")).alias("cohort_month"), index.alias("month_index"))
        .agg(F.count("*").alias("active_customers"))
    )
    size = F.max("active_customers").over(Window.partitionBy("cohort_month"))
    return (
        active.withColumn("cohort_size", size)
        .withColumn("retention_pct", m.percent(F.col("active_customers"), F.col("cohort_size")))
        .orderBy("cohort_month", "month_index")
    )


def churn(shop: Shop, days: int = 180) -> DataFrame:
    """Repeat or one-time, and churned if the last order is ``days`` behind the data's last order."""
    done = completed_orders(shop)
    today = done.agg(F.max("order_date")).scalar()
    return (
        done.groupBy("customer_id")
        .agg(F.count("*").alias("num_orders"), F.max("order_date").alias("last_order_date"))
        .join(shop.customers.select("customer_id"), "customer_id", "left_semi")
        .withColumn("purchase_type", F.when(F.col("num_orders") == 1, "one-time").otherwise("repeat"))
        .withColumn(
            "churn_status", F.when(F.datediff(today, "last_order_date") > days, "churned").otherwise("active")
        )
        .orderBy(F.desc("num_orders"), "customer_id")
    )


def frequency_segments(shop: Shop) -> DataFrame:
    n = F.col("num_orders")
    segment = F.when(n == 1, "one-time").when(n.between(2, 4), "occasional").otherwise("loyal")
    return (
        completed_orders(shop)
        .groupBy("customer_id")
        .agg(F.count("*").alias("num_orders"))
        .groupBy(segment.alias("frequency_segment"))
        .agg(F.count("*").alias("num_customers"))
        .orderBy(F.desc("num_customers"), "frequency_segment")
    )


def spend_tiers(shop: Shop, low: float = 100, high: float = 500) -> DataFrame:
    spend = F.col("spend")
    tier = F.when(spend < low, "low").when(spend < high, "medium").otherwise("high")
    return (
        customer_spend(shop)
        .groupBy(tier.alias("spend_tier"))
        .agg(F.count("*").alias("num_customers"), F.sum("spend").alias("_spend"))
        .select(
            "spend_tier",
            "num_customers",
            m.mean(F.col("_spend"), F.col("num_customers")).alias("avg_spend_in_tier"),
        )
        .orderBy(F.desc("avg_spend_in_tier"))
    )


# Lowest total of three 1-5 scores, and the segment from there on.
RFM_SEGMENTS = ((13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (4, "At Risk"), (0, "Lost"))


def rfm_segment(score: Column) -> Column:
    return F.coalesce(*[F.when(score >= lowest, label) for lowest, label in RFM_SEGMENTS])


def rfm(shop: Shop, limit: int | None = None) -> DataFrame:
    """Recency, frequency and monetary quintiles (5 = best) and the segment of their sum."""
    today = completed_orders(shop).agg(F.max("order_date")).scalar()
    scored = materialise(
        customer_spend(shop).select(
            "customer_id",
            "name",
            F.datediff(today, "last_order").cast("long").alias("recency_days"),
            F.col("num_orders").alias("frequency"),
            m.to_double("spend").alias("monetary"),
        ),
        "rfm",
    )
    scored = ranking.ntiles(
        scored,
        {
            "r_score": (5, ["-recency_days", "customer_id"]),
            "f_score": (5, ["frequency", "customer_id"]),
            "m_score": (5, ["monetary", "customer_id"]),
        },
    )
    scored = scored.withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    scored = scored.withColumn("rfm_segment", rfm_segment(F.col("rfm_total")))
    return _limited(scored.orderBy(F.desc("rfm_total"), "customer_id"), limit)


def order_status(shop: Shop) -> DataFrame:
    every = shop.orders.agg(F.count("*")).scalar()
    return (
        shop.orders.groupBy("status")
        .agg(F.count("*").alias("num_orders"))
        .withColumn("pct_of_all_orders", m.percent(F.col("num_orders"), every))
        .orderBy(F.desc("num_orders"), "status")
    )


# ---- registry --------------------------------------------------------------------------


class Report(NamedTuple):
    description: str
    build: Callable[..., DataFrame]
    takes_limit: bool


REPORTS: dict[str, Report] = {
    "revenue_by_customer": Report("Revenue and number of orders per customer", revenue_by_customer, True),
    "revenue_by_category": Report("Revenue and units per product category", revenue_by_category, False),
    "revenue_by_month": Report("Revenue and orders per calendar month", revenue_by_month, False),
    "top_products": Report("Products with the highest revenue", top_products, True),
    "top_customers": Report("Customers ranked by lifetime value", top_customers, True),
    "aov_by_segment": Report("Average order value per customer segment", aov_by_segment, False),
    "running_total": Report("Monthly revenue with running total and 3-month average", running_total, False),
    "growth_rate": Report("Month-over-month revenue growth", growth_rate, False),
    "cohort_retention": Report("Retention per cohort of the first completed order", cohort_retention, False),
    "frequency_segments": Report("Customers by number of orders", frequency_segments, False),
    "spend_tiers": Report("Customers by total spend", spend_tiers, False),
    "rfm": Report("Recency, frequency, monetary segmentation", rfm, True),
    "order_status": Report("Orders by status", order_status, False),
}


def list_reports() -> list[tuple[str, str, bool]]:
    return [(name, r.description, r.takes_limit) for name, r in REPORTS.items()]


def run_report(name: str, shop: Shop, limit: int | None = 10) -> DataFrame:
    """A report by name. ``limit`` has to be positive (None: all rows); reports without a limit ignore it."""
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; known: {', '.join(REPORTS)}")
    if limit is not None and limit <= 0:
        raise ValueError("limit must be a positive integer")
    report = REPORTS[name]
    return report.build(shop, limit=limit) if report.takes_limit else report.build(shop)
