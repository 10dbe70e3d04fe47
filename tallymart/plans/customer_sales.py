"""Customer questions on order lines (customer_id, order_id, sales)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import ranking
from tallymart.session import materialise


def _above_average(rows: DataFrame, column: str) -> DataFrame:
    """Rows above the mean of ``column``: ``x * count > sum`` is exact, a decimal average is cut to six digits."""
    n = rows.agg(F.count(column).cast("decimal(18,0)")).scalar()
    return rows.filter(F.col(column) * n > rows.agg(F.sum(column)).scalar())


def above_average_lines(lines: DataFrame) -> DataFrame:
    return _above_average(lines, "sales")


def highest_line(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id").agg(F.max("sales").alias("highest_order_value"))


def total_sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id").agg(F.sum("sales").alias("total_sales"))


def above_average_customers(lines: DataFrame) -> DataFrame:
    return _above_average(total_sales(lines), "total_sales")


def ranked(lines: DataFrame) -> DataFrame:
    return ranking.rank(materialise(total_sales(lines)), ["-total_sales"], "customer_rank")


def numbered_lines(lines: DataFrame, tie_break: Sequence[str]) -> DataFrame:
    """Row number of each line within its customer, largest sale first."""
    return ranking.row_number_by(materialise(lines), ["customer_id"], ["-sales", *tie_break], "row_num")


def top_ranked(lines: DataFrame, k: int = 3) -> DataFrame:
    return ranking.top_ranked(total_sales(lines), k, ["-total_sales"], "customer_rank")


def ranked_names(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer name, total sales and rank; the rank counts customers that the join keeps."""
    named = materialise(total_sales(lines).join(customers.select("customer_id", "customer_name"), "customer_id"))
    return ranking.rank(named, ["-total_sales"], "customer_rank").drop("customer_id")


def top(lines: DataFrame, limit: int = 5) -> DataFrame:
    return total_sales(lines).orderBy(F.desc("total_sales"), "customer_id").limit(limit)


def bottom(lines: DataFrame, limit: int = 5) -> DataFrame:
    return total_sales(lines).orderBy("total_sales", "customer_id").limit(limit)


def single_order(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("total_orders"))
        .filter("total_orders = 1")
    )
