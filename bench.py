"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the number of local cores. All queries run once
to warm up, then each three times for the median; results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymart import catalog  # noqa: E402
from tallymart.catalog.tables import Bound  # noqa: E402

HEADLINES = [
    "rep_revenue_by_customer",
    "rep_revenue_by_category",
    "rep_revenue_by_month",
    "rep_top_products",
    "rep_customer_ltv",
    "rep_aov_by_segment",
    "rep_running_total",
    "rep_customer_order_history",
    "rep_cohort_retention",
    "rep_churn",
    "rep_spend_tiers",
    "rep_rfm",
    "rep_order_status",
    "rep_sales_by_region",
    "rep_numbered_lines",
    "rep_retail_store_revenue",
    "win_rank_distributed",
    "clean_items",
    "clean_dedup_first",
    "clean_median_sales",
    "prof_null_blank_audit",
    "prof_dup_rows",
    "dq_fk",
    "merge_scd1",
    "scd2_apply",
]


def narrow(bound: Bound) -> DataFrame:
    """A filter: no shuffle but for the final count."""
    return bound.orders.filter(F.col("priority") == "1-URGENT").agg(F.count("*"))


def wide(bound: Bound) -> DataFrame:
    """A grouping: one shuffle."""
    return bound.orders.groupBy("customer_id").count()


def plain_rank(bound: Bound) -> DataFrame:
    """The one-task window that ``win_rank_distributed`` stands against."""
    order = Window.orderBy(F.desc("quantity"), "line_total")
    return bound.items.select("order_id", F.rank().over(order), F.dense_rank().over(order))


COMPARISONS = {"narrow_filter": narrow, "wide_grouping": wide, "plain_one_task_rank": plain_rank}


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_of(run, repeats: int = 3) -> float:
    return round(statistics.median(timed(run) for _ in range(repeats)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    headlines = {name: lambda q=registered[name]: q(spark, sf_dir) for name in HEADLINES}
    comparisons = {name: lambda q=build: q(Bound(spark, sf_dir)) for name, build in COMPARISONS.items()}
    for run in [*headlines.values(), *comparisons.values()]:
        timed(run)
    seconds = {name: median_of(run) for name, run in headlines.items()}
    compared = {name: median_of(run) for name, run in comparisons.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "comparisons": compared,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
