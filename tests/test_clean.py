from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart.functions import dates, money, text
from tallymart.operators import clean, profile
from tallymart.plans import deals, retail, shop_cleaning
from tests.conftest import rows


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.select("i", expr(F.col("c")).alias("x")).orderBy("i").select("x").collect()]


def test_text_keys(spark):
    raw = ["  A@B.COM  ", "\tx@y.z\n", None, "", "NaN", "None", "a b"]
    keys = column(spark, raw, "string", lambda c: text.missing_to_null(text.text_key(c)))
    assert keys == ["a@b.com", "x@y.z", None, None, None, None, "a b"]


def test_strip_space_keeps_null(spark):
    assert column(spark, [" a ", " b", None], "string", text.strip_space) == ["a", " b", None]


def test_same_ignoring_case(spark):
    assert column(spark, ["SOUTH", "south", "North", None], "string", lambda c: text.same_ignoring_case(c, "South")) == [
        True,
        True,
        False,
        None,
    ]


def test_tolerant_dates(spark):
    raw = ["2099-13-45", "2030-01-01", "", "2024-02-29", "2023-02-29", "4/24/2017", "12/3/2016", None, "soon", "11-08-2016", "31-02-2016"]
    assert column(spark, raw, "string", dates.tolerant_date) == [
        None,
        date(2030, 1, 1),
        None,
        date(2024, 2, 29),
        None,
        date(2017, 4, 24),
        date(2016, 12, 3),
        None,
        None,
        date(2016, 8, 11),
        None,
    ]


def test_the_cleaners_take_other_date_formats(spark):
    raw = spark.createDataFrame([(1, "a@x", "CA", "2024.02.29", "Ann")], "customer_id int, email string, country string, signup_date string, name string")
    assert shop_cleaning.clean_customers(raw, ["customer_id"]).isEmpty()
    assert shop_cleaning.clean_customers(raw, ["customer_id"], ("yyyy.MM.dd",)).first().signup_date == date(2024, 2, 29)


def test_the_median_keeps_the_type_of_its_column(spark):
    df = spark.sql("select cast(v as decimal(10,2)) v from values (1.10), (null), (2.30) t(v)")
    filled = clean.fill_median(df, "v")
    assert filled.schema == df.schema and rows(filled) == [(Decimal("1.10"),), (Decimal("1.70"),), (Decimal("2.30"),)]


def test_tolerant_numbers(spark):
    raw = ["1.5", " 2 ", "abc", "", "NaN", None, "-3"]
    assert column(spark, raw, "string", dates.tolerant_number) == [1.5, 2.0, None, None, None, None, -3.0]


def test_month_functions(spark):
    days = [date(2023, 12, 31), date(2024, 1, 1)]
    assert column(spark, days, "date", dates.month_label) == ["2023-12", "2024-01"]
    first, second = column(spark, days, "date", dates.month_number)
    assert second - first == 1
    assert column(spark, ["15-08-2016"], "string", dates.month_slice) == ["08-2016"]


def test_mean_and_percent_round_half_up_once(spark):
    row = spark.sql("select cast(0.01 as decimal(18,2)) a, 2L n, cast(-0.01 as decimal(18,2)) b").select(
        money.mean(F.col("a"), F.col("n")), money.mean(F.col("b"), F.col("n")), money.percent(F.lit(1), F.lit(0))
    )
    assert tuple(row.first()) == (0.01, -0.01, None)


def test_fill_median_and_mode(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (2, None, "a"), (3, 1.0, "a"), (4, 2.0, "b"), (5, 1.0, None)], "i int, d double, s string")
    assert rows(clean.fill_median(df, "d").select("i", "d"))[1] == (2, 1.5)
    assert rows(clean.fill_mode(df, "s").select("i", "s"))[4] == (5, "a")


def test_fill_of_an_all_null_column_leaves_it(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, d double")
    assert rows(clean.fill_median(df, "d")) == [(1, None), (2, None)]
    assert rows(clean.fill_mode(df, "d")) == [(1, None), (2, None)]


def test_keep_first_follows_the_order_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only"), (None, 1, "x"), (None, 0, "y")], "k string, o int, v string")
    first = clean.keep_first(df, ["k"], ["o"])
    assert rows(first.select("k", "v")) == [(None, "y"), ("a", "early"), ("b", "only")]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_reachable_contacts(spark):
    df = spark.createDataFrame([(1, "a", "u"), (2, None, "u"), (3, "a", "  "), (4, "a", None)], "i int, email string, username string")
    assert rows(clean.keep_reachable(df).select("i")) == [(1,)]


def test_standard_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`Row ID` int, `Sub-Category` int")
    assert clean.standardise_names(df).columns == ["Row_ID", "Sub_Category"]
    with pytest.raises(ValueError):
        clean.standardise_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


@pytest.fixture(scope="module")
def raw_shop(spark):
    customers = [
        (1, " Ann ", " ANN@X.COM ", None, "2024-01-05", "VIP", 1),
        (1, " Ann ", " ANN@X.COM ", None, "2024-01-05", "VIP", 1),  # exact copy
        (2, "Bob", "nan", "India", "2024-01-05", "Premium", 1),  # first copy without email,
        (2, "Bob", "bob@x.com", "India", "2024-01-05", "Premium", 2),  # so a later one does not count
        (3, None, "cy@x.com", "Peru", "1/2/2024", "Regular", 1),
        (4, "Dee", "dee@x.com", "Peru", "2024-13-45", "Regular", 1),  # bad date
    ]
    products = [
        (10, "pen", None, "1.50", 1, 1),
        (11, "cup", "Home", None, 1, 1),  # no price
        (12, "mat", "Home", "-2", 1, 1),  # negative price,
        (12, "mat", "Home", "3", 1, 2),  # the later copy is the first with a price
    ]
    orders = [
        (100, 1, "2024-03-01", "completed", 1),
        (101, 1, "2024-03-02", "pending", 1),  # will have no items
        (102, 99, "2024-03-02", "completed", 1),  # no such customer
        (103, 3, "2030-01-01", "completed", 1),  # in the future
        (104, 3, "2024-03-03", "lost", 1),  # no such status
    ]
    items = [
        (1000, 100, 10, "2", "1.50"),
        (1001, 100, 12, "1", "3.00"),
        (1001, 100, 12, "9", "3.00"),  # repeated key
        (1002, 100, 11, "1", "1.00"),  # product was dropped
        (1003, 101, 10, "0", "1.00"),  # no quantity
        (1004, 102, 10, "1", "1.00"),  # order was dropped
        (1005, 100, 10, "many", "1.00"),
    ]
    return shop_cleaning.RawShop(
        spark.createDataFrame(customers, "customer_id int, name string, email string, country string, signup_date string, segment string, seq int"),
        spark.createDataFrame(products, "product_id int, product_name string, category string, price string, active int, seq int"),
        spark.createDataFrame(orders, "order_id int, customer_id int, order_date string, status string, seq int"),
        spark.createDataFrame(items, "order_item_id int, order_id int, product_id int, quantity string, unit_price string"),
    )


ARRIVAL = {"customers": ["seq"], "products": ["seq"], "orders": ["seq"], "items": ["quantity"]}


def test_clean_shop(raw_shop):
    shop = shop_cleaning.clean_shop(raw_shop, ARRIVAL, ["order_item_id"])
    assert rows(shop.customers.select("customer_id", "name", "email", "country")) == [
        (1, "Ann", "ann@x.com", "Unknown"),
        (3, None, "cy@x.com", "Peru"),
    ]
    assert rows(shop.products.select("product_id", "category", "price")) == [(10, "Uncategorized", 1.5), (12, "Home", 3.0)]
    assert rows(shop.orders.select("order_id", "order_date")) == [(100, date(2024, 3, 1))]
    assert [(r[0], float(r[1])) for r in rows(shop.items.select("order_item_id", "line_total"))] == [(1000, 3.0), (1001, 3.0)]
    assert rows(shop.audit.select("table_name", "step", "rows_before", "rows_after", "removed")) == [
        ("customers", "clean", 6, 2, 4),
        ("order_items", "clean", 7, 2, 5),
        ("orders", "clean", 5, 2, 3),
        ("orders", "without items", 2, 1, 1),
        ("products", "clean", 4, 2, 2),
    ]


def test_cleaning_again_changes_nothing(raw_shop):
    once = shop_cleaning.clean_shop(raw_shop, ARRIVAL, ["order_item_id"])
    text_dates = shop_cleaning.RawShop(
        once.customers.withColumn("signup_date", F.col("signup_date").cast("string")),
        once.products.withColumn("price", F.col("price").cast("string")),
        once.orders.withColumn("order_date", F.col("order_date").cast("string")),
        once.items,
    )
    twice = shop_cleaning.clean_shop(text_dates, ARRIVAL, ["order_item_id"])
    for a, b in zip(once[:4], twice[:4], strict=True):
        assert rows(a) == rows(b)


def test_clean_shop_of_empty_tables(spark, raw_shop):
    empty = shop_cleaning.RawShop(*[df.limit(0) for df in raw_shop])
    shop = shop_cleaning.clean_shop(empty, ARRIVAL, ["order_item_id"])
    assert all(df.isEmpty() for df in shop[:4])
    assert {r.removed for r in shop.audit.collect()} == {0}


def test_injected_defects_are_found_and_removed(spark):
    good = spark.createDataFrame([(i, "x") for i in range(20)], "id int, city string")
    no_city = good.limit(5).select((F.col("id") + 100000).alias("id"), F.lit(None).cast("string").alias("city"))
    dirty = good.unionByName(good.limit(5)).unionByName(no_city)
    assert profile.duplicate_row_count(dirty).first().n_duplicates == 5
    assert profile.rows_with_null(dirty, ["city"]).count() == 5
    cleaned = clean.fill_constants(clean.drop_duplicate_rows(dirty), {"city": "Unknown"})
    # rows without a city got keys of their own, so they stay
    assert cleaned.count() == 25
    assert profile.total_nulls(cleaned).first()[0] == 0


def test_null_blank_audit(spark):
    df = spark.createDataFrame([(1, " ", None), (2, None, None), (3, "a", 1)], "i int, s string, n int")
    assert rows(profile.null_blank_audit(df)) == [("n", 2, 0), ("s", 1, 1)]


def test_info_and_shuffles(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(profile.info(df)) == [(1, "a", "int", True, 2), (2, "b", "string", True, 1)]
    assert "Exchange" not in profile.plan_text(df.filter("a > 1"))
    assert "Exchange" in profile.plan_text(df.groupBy("a").count())


def test_store_revenue_from_raw_rows(spark):
    schema = "user_id int, status string, price decimal(10,2), sale_amount decimal(18,2), revenue decimal(18,2), email string, username string, raw_timestamp string, store_id string"
    data = [
        (1, None, None, None, None, "e", "u", "2024-01-01 10:00:00", "S1"),
        (2, "ok", 10, 5, 20, "e", "u", "bad", "S1"),
        (2, "ok", 10, 5, 20, "e", "u", "bad", "S1"),
        (3, "ok", 10, 5, 20, None, "u", "bad", "S2"),
        (4, "ok", 3, 5, 30, "e", "u", "bad", "S2"),
    ]
    data = [tuple(__import__("decimal").Decimal(v) if i in (2, 3, 4) and v is not None else v for i, v in enumerate(r)) for r in data]
    result = retail.store_revenue(spark.createDataFrame(data, schema))
    assert [tuple(r) for r in result.collect()] == [("S2", 30.0, 1, 3.0), ("S1", 20.0, 2, 5.0)]


def test_deals(spark):
    schema = "title string, rating double, discount double, initial_price double, final_price double, seller_name string, seller_information string, videos string, what_customers_said string, variations string"
    data = [
        ("a", 4.6, 70.0, 8000.0, 1.0, "s", None, None, None, None),
        ("b", 4.5, 66.0, 7000.0, 1.0, None, "i", None, None, None),
        ("c", 5.0, None, 100.0, 1.0, "s", "i", None, None, None),
    ]
    df = spark.createDataFrame(data, schema)
    assert tuple(deals.deal_counts(df).first()) == (2, 2, 1, 1)
    cleaned = deals.cleaned(df)
    assert "videos" not in cleaned.columns
    assert rows(cleaned.select("title", "discount", "seller_name", "seller_information", "total_amount")) == [
        ("a", 70.0, "s", "i", 2400.0),
        ("b", 66.0, "s", "i", 2380.0),
        ("c", 68.0, "s", "i", 32.0),
    ]


def test_mean_divides_once(spark):

    from tallymart.functions import money

    rows = [("100000.00", 20000001, 0.0), ("2010000.00", 2000001, 1.0), ("-0.01", 2, -0.01), ("0.01", 3, 0.0), ("12.35", 1, 12.35)]
    given = spark.createDataFrame([(Decimal(s), n, e) for s, n, e in rows], "s decimal(38,2), n long, e double")
    assert all(r.m == r.e for r in given.select("e", money.mean(F.col("s"), F.col("n")).alias("m")).collect())


def test_numbers_without_type_letters(spark):
    from tallymart.functions.dates import tolerant_number

    texts = ["10d", "5f", " 7 ", "1e3", ".5", "-2.", "NaN", "abc", "", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(tolerant_number(F.col("t")).alias("n")).collect()
    assert [r.n for r in found] == [None, None, 7.0, 1000.0, 0.5, -2.0, None, None, None, None]


def test_above_average_is_exact(spark):
    from tallymart.plans import customer_sales

    lines = spark.range(100_000).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") == 0, 4.99).otherwise(5.00).cast("decimal(12,2)").alias("sales")
    )
    assert customer_sales.above_average_lines(lines).count() == 99_999
    assert customer_sales.above_average_customers(lines).count() == 99_999
