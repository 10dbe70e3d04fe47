from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart.operators import merge, quality
from tallymart.session import new_path
from tallymart.sources import writers
from tests.conftest import rows

DAY1, DAY2, DAY3 = date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1)


def table(spark, data, schema="id int, mode string, qty int"):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def target(spark):
    return table(spark, [(1, "a", 1), (2, "b", 2), (3, None, 3)])


@pytest.fixture
def feed(spark):
    return table(spark, [(2, None, 9), (4, "n", 4)])


def test_upsert_takes_nulls_of_the_feed(target, feed):
    assert rows(merge.upsert(target, feed, ["id"])) == [(1, "a", 1), (2, None, 9), (3, None, 3), (4, "n", 4)]


def test_upsert_of_some_columns(target, feed):
    merged = merge.upsert(target, feed, ["id"], update_columns=["qty"])
    assert rows(merged) == [(1, "a", 1), (2, "b", 9), (3, None, 3), (4, "n", 4)]


def test_upsert_ignores_the_order_of_feed_columns(target, feed):
    assert rows(merge.upsert(target, feed.select("qty", "mode", "id"), ["id"])) == rows(merge.upsert(target, feed, ["id"]))


@pytest.mark.parametrize("bad", [[(1, "x", 1), (1, "y", 2)], [(None, "x", 1)]])
def test_repeated_or_missing_feed_keys_are_refused(spark, target, bad):
    with pytest.raises(ValueError, match="feed"):
        merge.upsert(target, table(spark, bad), ["id"])
    with pytest.raises(ValueError, match="feed"):
        merge.scd2_apply(merge.scd2_init(target, DAY1), table(spark, bad), ["id"], ["qty"], DAY2)


def test_a_feed_takes_the_types_of_the_target(spark, target):
    wide = table(spark, [(1, "z", 5)], "id bigint, mode string, qty bigint")
    assert merge.upsert(target, wide, ["id"]).dtypes == target.dtypes
    history = merge.scd2_init(target, DAY1)
    assert merge.scd2_apply(history, wide, ["id"], ["qty"], DAY2).dtypes == history.dtypes


def test_update_where(target):
    updated = merge.update_where(target, F.col("mode") == "a", {"qty": F.col("qty") + 10})
    assert rows(updated) == [(1, "a", 11), (2, "b", 2), (3, None, 3)]
    assert updated.dtypes == target.dtypes


def test_merge_metrics(target, feed):
    assert tuple(merge.merge_metrics(target, feed, ["id"], DAY1).first()) == (1, 1, 2, DAY1)


def test_small_feed_does_not_shuffle_the_target(spark):
    target = spark.range(100_000).select(F.col("id").cast("int"), F.lit("a").alias("mode"), F.lit(1).alias("qty"))
    stored = new_path(spark, "target")
    target.write.parquet(stored)
    merged = merge.upsert(spark.read.parquet(stored), table(spark, [(5, "x", 2), (-1, "n", 1)]), ["id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter, BuildRight" in plan and "LeftSemi, BuildRight" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the matched keys, no more than the feed has
    assert merged.count() == 100_001


def test_scd2_versions(spark, target, feed):
    history = merge.scd2_init(target, DAY1)
    result = merge.scd2_apply(history, feed, ["id"], ["mode", "qty"], DAY2)
    assert rows(result) == [
        (1, "a", 1, DAY1, None, True),
        (2, None, 9, DAY2, None, True),
        (2, "b", 2, DAY1, DAY2, False),
        (3, None, 3, DAY1, None, True),
        (4, "n", 4, DAY2, None, True),
    ]


def test_the_same_feed_again_adds_nothing(target, feed):
    once = merge.scd2_apply(merge.scd2_init(target, DAY1), feed, ["id"], ["mode", "qty"], DAY2)
    twice = merge.scd2_apply(once, feed, ["id"], ["mode", "qty"], DAY3)
    assert rows(twice) == rows(once)


def test_three_feeds_keep_one_current_row_per_key(spark, target, feed):
    history = merge.scd2_init(target, DAY1)
    history = merge.scd2_apply(history, feed, ["id"], ["mode", "qty"], DAY2)
    third = table(spark, [(2, "c", 9), (3, "new", 3), (5, "e", 5)])
    history = merge.scd2_apply(history, third, ["id"], ["mode", "qty"], DAY3)
    assert quality.keys_unique(history.filter("is_current"), ["id"]).first().ok
    assert rows(history.filter("id = 2").select("mode", "effective_date", "end_date")) == [
        (None, DAY2, DAY3),
        ("b", DAY1, DAY2),
        ("c", DAY3, None),
    ]
    assert [r.effective_date for r in merge.scd2_history(history, third, ["id"]).filter("id = 3").collect()] == [DAY1, DAY3]


def test_changes_from_and_to_null(spark, target):
    history = merge.scd2_init(target, DAY1)
    feed = table(spark, [(2, None, 2), (3, "x", 3)])
    assert rows(merge.scd2_changes(history, feed, ["id"], ["mode"]).select("id")) == [(2,), (3,)]
    assert merge.scd2_changes(history, feed, ["id"], ["mode"], null_safe=False).isEmpty()
    same = merge.scd2_apply(history, feed, ["id"], ["mode"], DAY2, null_safe=False)
    assert rows(same) == rows(history)


def test_untracked_changes_open_no_version(spark, target):
    history = merge.scd2_init(target, DAY1)
    result = merge.scd2_apply(history, table(spark, [(1, "a", 77)]), ["id"], ["mode"], DAY2)
    assert rows(result) == rows(history)


def test_empty_sides(spark, target, feed):
    assert rows(merge.upsert(target.limit(0), feed, ["id"])) == rows(feed)
    assert rows(merge.upsert(target, feed.limit(0), ["id"])) == rows(target)
    assert rows(merge.scd2_apply(merge.scd2_init(target.limit(0), DAY1), feed, ["id"], ["qty"], DAY2).select("id")) == [(2,), (4,)]


def test_publish_replaces_a_table_that_the_query_reads(spark, target, feed):
    writers.replace_table(target, "snapshots", new_path(spark, "table"))
    first = rows(spark.table("snapshots"))
    merged = merge.upsert_table("snapshots", feed, ["id"], new_path(spark, "table"))
    assert rows(merged) == [(1, "a", 1), (2, None, 9), (3, None, 3), (4, "n", 4)]
    assert first == rows(target)
    spark.sql("DROP TABLE snapshots")


# ---- placing orders --------------------------------------------------------------------


@pytest.fixture
def shop(spark):
    return {
        "customers": spark.createDataFrame([(1,), (2,)], "customer_id int"),
        "products": spark.createDataFrame([(10, 300), (11, 1)], "product_id int, stock_qty int"),
        "orders": spark.createDataFrame([(100, 1, Decimal(5))], "order_id int, customer_id int, total_amount decimal(12,2)"),
        "items": spark.createDataFrame([(100, 10, 1)], "order_id int, product_id int, quantity int"),
    }


def place(spark, shop, customer=2, amount=8, lines=((101, 10, 1), (101, 11, 1), (101, 10, 2))):
    new_orders = spark.createDataFrame([(101, customer, Decimal(amount))], shop["orders"].schema)
    new_items = spark.createDataFrame(list(lines), shop["items"].schema)
    return merge.place_orders(*shop.values(), new_orders, new_items)


def test_an_order_takes_its_items_out_of_stock(spark, shop):
    placed = merge.accept(place(spark, shop))
    assert rows(placed.products) == [(10, 297), (11, 0)]
    assert placed.orders.count() == 2 and placed.items.count() == 4


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"customer": 999}, "foreign_key"),
        ({"amount": -1}, "total_amount >= 0"),
        ({"lines": ((101, 11, 2),)}, "stock_qty >= 0"),
        ({"lines": ((101, 12, 1),)}, "foreign_key"),
        ({"lines": ((555, 10, 1),)}, "foreign_key"),
        ({"lines": ((101, 10, 0),)}, "quantity > 0"),
    ],
)
def test_a_broken_rule_refuses_the_order(spark, shop, change, rule):
    placed = place(spark, shop, **change)
    assert rule in [r.rule for r in placed.violations.collect()]
    with pytest.raises(ValueError, match="order refused"):
        merge.accept(placed)


def test_order_and_item_keys_are_new_and_unique(spark, shop):
    def broken(orders, items, item_key=("order_id", "product_id")):
        new_orders = spark.createDataFrame(orders, shop["orders"].schema)
        new_items = spark.createDataFrame(items, shop["items"].schema)
        placed = merge.place_orders(*shop.values(), new_orders, new_items, item_key)
        return {(r.table_name, r.rule, r.n_violations) for r in placed.violations.collect()}

    good = (101, 2, Decimal(8))
    assert broken([good], [(101, 10, 1)]) == set()
    assert broken([good, good], [(101, 10, 1)]) == {("orders", "primary_key", 1)}
    assert broken([(100, 2, Decimal(8))], [(100, 11, 1)]) == {("orders", "new_key", 1)}
    assert broken([(101, None, Decimal(8))], [(101, 10, 1)]) == {("orders", "not_null customer_id", 1)}
    assert broken([good], [(101, 10, 1), (101, 10, 2)]) == {("order_items", "primary_key", 1)}
    assert broken([good], [(100, 10, 1)]) == {("order_items", "new_key", 1)}
    assert broken([good], [(101, 10, None)]) == {("order_items", "not_null quantity", 1)}


def test_normalise_keeps_one_row_per_product(spark):
    flat = spark.createDataFrame(
        [(1, "o1", "c1", "Ann", "VIP", "p1", "Pen", "Office", 5), (2, "o1", "c1", "Ann", "VIP", "p1", "Pencil", "Office", 7)],
        "row_id int, order_id string, customer_id string, customer_name string, segment string, product_id string, product_name string, category string, sales int",
    )
    parts = merge.normalise_sales(flat)
    assert rows(parts.customers) == [("c1", "Ann", "VIP")]
    assert rows(parts.products) == [("p1", "Pencil", "Office")]
    assert parts.orders.count() == 2


def test_large_feed_is_one_join_of_many_parts(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        target = spark.range(40_000).select(
            F.when(F.col("id") % 10 != 9, F.col("id")).alias("id"), F.lit("a").alias("mode"), F.col("id").cast("int").alias("qty")
        )
        target = target.unionByName(target.limit(20))  # keys may repeat
        stored, source = new_path(spark, "target"), new_path(spark, "source")
        target.write.parquet(stored)
        spark.range(0, 80_000, 3).filter("id % 10 != 9").select("id", F.lit(None).cast("string").alias("mode"), F.lit(-1).alias("qty")).write.parquet(source)
        old, new = spark.read.parquet(stored), spark.read.parquet(source)
        key = F.coalesce(F.col("id"), F.lit(-1))
        for update in (None, ["qty"]):
            monkeypatch.setattr(merge, "TASK_BYTES", 1 << 17)
            merged = merge.upsert(old, new, ["id"], update)
            plan = merged._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Join") == 1 and "SortMergeJoin" in plan
            assert "hashpartitioning(id" in plan and ", 9)" in plan  # more parts than the session's 4
            monkeypatch.setattr(merge, "KEY_BYTES", 0)
            small = merge.upsert(old, new, ["id"], update)
            monkeypatch.undo()
            assert merged.dtypes == small.dtypes == old.dtypes
            a, b = (df.groupBy(key.alias("id"), "mode", "qty").count() for df in (merged, small))
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
