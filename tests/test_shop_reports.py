import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.catalog.tables import Bound
from tallymart.plans import customer_sales, shop
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bound(spark):
    return Bound(spark, SF)


def total(df, column):
    return round(df.agg(F.sum(column)).first()[0], 2)


def test_reports_agree_on_the_number_of_completed_orders(bound):
    s = bound.shop
    by_month = total(shop.revenue_by_month(s), "orders_count")
    assert by_month == total(shop.aov_by_segment(s), "num_orders")
    assert by_month == total(shop.revenue_by_customer(s), "total_orders")


def test_reports_agree_on_the_number_of_buyers(bound):
    s = bound.shop
    buyers = shop.revenue_by_customer(s).count()
    assert buyers == total(shop.spend_tiers(s), "num_customers")
    assert shop.churn(s).count() == total(shop.frequency_segments(s), "num_customers")
    assert shop.churn(s).count() == total(shop.cohort_sizes(s), "cohort_size")


def test_category_revenue_is_the_last_running_total(bound):
    s = bound.shop
    last = shop.running_total(s).orderBy(F.desc("month")).first()
    assert total(shop.revenue_by_category(s), "total_revenue") == last.running_total


def test_month_zero_of_a_cohort_is_whole(bound):
    start = shop.cohort_retention(bound.shop).filter("month_index = 0")
    assert start.filter("retention_pct <> 100 or active_customers <> cohort_size").isEmpty()
    assert rows(start.select("cohort_month", "cohort_size")) == rows(shop.cohort_sizes(bound.shop))


def test_status_shares_sum_to_hundred(bound):
    assert abs(total(shop.order_status(bound.shop), "pct_of_all_orders") - 100) < 0.05


@pytest.mark.parametrize("report", [shop.top_customers, shop.customer_ltv, shop.top_products, shop.revenue_by_customer, shop.rfm])
def test_a_limit_is_the_head_of_the_whole_report(bound, report):
    limited = [tuple(r) for r in report(bound.shop, limit=7).collect()]
    whole = [tuple(r) for r in report(bound.shop, limit=None).collect()]
    assert limited == whole[:7]


@pytest.mark.parametrize("report", [shop.top_customers, shop.customer_ltv])
def test_a_limit_beyond_the_customers_gives_the_whole_report(bound, report):
    limited = [tuple(r) for r in report(bound.shop, limit=10**6).collect()]
    assert limited == [tuple(r) for r in report(bound.shop, limit=None).collect()]


def test_order_history_peers_share_the_running_spend(spark):
    orders = spark.sql(
        "select * from values (1, 1, date '2024-01-01', 'completed'), (2, 1, date '2024-01-01', 'completed'), "
        "(3, 1, date '2024-01-02', 'completed'), (4, 1, date '2024-01-02', 'returned') t(order_id, customer_id, order_date, status)"
    )
    items = spark.sql(
        "select o as order_id, 1 as product_id, 1 as quantity, cast(v as decimal(18,2)) as line_total "
        "from values (1, 1), (2, 1), (3, 1), (4, 5) t(o, v)"
    )
    customers = spark.sql("select 1 as customer_id, 'Ann' as name, 'VIP' as segment")
    products = spark.sql("select 1 as product_id, 'pen' as product_name, 'Office' as category")
    history = shop.customer_order_history(shop.Shop(customers, products, orders, items))
    assert [(r.order_id, r.running_customer_spend) for r in history.collect()] == [(1, 2.0), (2, 2.0), (3, 3.0)]


def test_growth_skips_months_without_revenue(spark, bound):
    growth = shop.growth_rate(bound.shop).collect()
    assert growth[0].prev_month_revenue is None and growth[0].mom_growth_pct is None
    for before, now in zip(growth, growth[1:]):
        assert now.prev_month_revenue == before.revenue


def test_registry(bound):
    names = [name for name, _, _ in shop.list_reports()]
    assert len(names) == 13 and all(description for _, description, _ in shop.list_reports())
    with pytest.raises(ValueError, match="unknown report"):
        shop.run_report("sales", bound.shop)
    for limit in (0, -1):
        with pytest.raises(ValueError, match="positive"):
            shop.run_report("order_status", bound.shop, limit)
    assert shop.run_report("top_products", bound.shop, 3).count() == 3
    assert shop.run_report("revenue_by_customer", bound.shop).count() == 10
    assert shop.run_report("revenue_by_customer", bound.shop, None).count() > 100
    assert shop.run_report("order_status", bound.shop, 1).count() == 3  # takes no limit


def test_every_report_keeps_its_columns_on_empty_tables(bound):
    empty = shop.Shop(*[df.limit(0) for df in bound.shop[:4]])
    for name in shop.REPORTS:
        result = shop.run_report(name, empty)
        assert result.columns == shop.run_report(name, bound.shop).columns
        assert result.isEmpty()


def test_stored_order_values_change_no_report(bound):
    stored = shop.with_order_values(bound.shop)
    for name in shop.REPORTS:
        assert rows(shop.run_report(name, stored, None)) == rows(shop.run_report(name, bound.shop, None))
    plan = shop.revenue_by_month(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_numbered_lines_equal_the_plain_window(bound):
    lines = bound.sales("order").select("customer_id", "order_id", "sales", "line_no", "product_id", "store_id", "ship_date")
    ties = ["order_id", "line_no", "product_id", "store_id", "ship_date"]
    place = F.row_number().over(Window.partitionBy("customer_id").orderBy(F.desc("sales"), *ties))
    assert rows(customer_sales.numbered_lines(lines, ties)) == rows(lines.withColumn("row_num", place))
