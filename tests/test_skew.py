"""Keys that hold a third of the rows: the plan has to split or shrink them."""

import pytest
from pyspark.sql import functions as F

from tallymart.operators import joins
from tallymart.plans import shop
from tallymart.session import materialise, tune
from tests.conftest import rows

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def big_world(spark):
    """Thresholds scaled down, so that a test table stands for a large one."""
    tune(spark)
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def hot_shop(big_world):
    """Order 0 and customer 0 hold a third of the lines and orders."""
    spark = big_world
    n = 60_000
    orders = spark.range(20_000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("long").alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("order_date"),
        F.lit("completed").alias("status"),
    )
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_000).cast("long").alias("order_id"),
        (F.col("id") % 100).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(18,2)").alias("line_total"),
    )
    customers = spark.range(600).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("name"), F.lit("VIP").alias("segment")
    )
    products = spark.range(100).select(
        F.col("id").alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category")
    )
    return shop.Shop(*[materialise(df.repartition(8)) for df in (customers, products, orders, items)])


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_order_is_split_in_the_product_report(hot_shop):
    assert "skew=true" in final_plan(shop.product_sales(hot_shop))


def test_a_hot_order_shrinks_to_one_row_before_the_order_join(hot_shop):
    values = shop.order_values(hot_shop)
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [order_id")  # the aggregate is below the join
    assert values.count() == hot_shop.items.select("order_id").distinct().count()


def test_a_left_join_with_a_hot_child_key_is_split(hot_shop):
    buyers = hot_shop.customers.select("customer_id", "name")
    orders = hot_shop.orders.select("customer_id", "order_id")
    joined = joins.keep_all_parents(buyers, orders, "customer_id")
    assert rows(joined) == rows(buyers.join(orders, "customer_id", "left"))
    assert "skew=true" in final_plan(joins.keep_all_parents(buyers, orders, "customer_id"))


def test_reports_of_a_hot_customer(hot_shop):
    top = shop.revenue_by_customer(hot_shop, limit=1).first()
    by_hand = (
        hot_shop.items.join(hot_shop.orders.filter("customer_id = 0"), "order_id").agg(F.sum("line_total")).first()[0]
    )
    assert (top.customer_id, top.total_revenue) == (0, float(by_hand))
    history = shop.customer_order_history(hot_shop, limit=None)
    assert history.count() == hot_shop.items.select("order_id").distinct().count()
