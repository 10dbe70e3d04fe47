import pytest
from pyspark.sql import functions as F

from tallymart.operators import quality
from tests.conftest import rows


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, -50, "a"), (None, None, None)], "id int, price int, code string")


def test_primary_key(products):
    assert rows(quality.primary_key_violations(products, ["id"])) == [(None, 1), (1, 2)]
    assert tuple(quality.primary_key("products", products, ["id"]).first()) == ("primary_key", "products", "id", 2)


def test_unique_ignores_null(products):
    assert rows(quality.unique_violations(products, ["code"])) == [("a", 2)]
    assert quality.unique("products", products, ["code"]).first().n_violations == 1


def test_a_check_on_null_passes(products):
    checks = quality.row_rules("products", products, {"price > 0": F.col("price") > 0, "short": F.length("code") < 9})
    assert rows(checks) == [("price > 0", "products", "", 1), ("short", "products", "", 0)]
    assert rows(quality.rule_violations(products, F.col("price") > 0).select("id")) == [(2,)]


def test_not_null_and_domain(products):
    assert quality.not_null("products", products, ["price"]).first().n_violations == 1
    assert quality.domain("products", products, {"code": ["a"]}).first().n_violations == 1


def test_foreign_key(spark, products):
    lines = spark.createDataFrame([(1,), (999,), (999,), (None,)], "product_id int")
    assert rows(quality.foreign_key_violations(lines, "product_id", products, "id")) == [(999, 2)]
    assert quality.foreign_key("lines", lines, "product_id", products, "id").first().n_violations == 2
    assert quality.foreign_key("lines", lines.limit(0), "product_id", products, "id").first().n_violations == 0


def test_reconcile(products):
    found = quality.reconcile({"a": 4, "b": F.lit(5).cast("long")}, {"a": products, "b": products})
    assert rows(found) == [("a", 4, 4, True), ("b", 5, 4, False)]


def test_keys_unique(products):
    assert tuple(quality.keys_unique(products, ["id"]).first()) == (4, 3, False)
    assert tuple(quality.keys_unique(products.limit(0), ["id"]).first()) == (0, 0, True)


def test_not_before(spark):
    customers = spark.sql("select 1 as customer_id, date '2024-02-01' as signup_date")
    orders = spark.sql("select 1 as customer_id, explode(array(date '2024-01-31', date '2024-02-01', null)) as order_date")
    check = quality.not_before("orders", orders, "order_date", customers, "signup_date", "customer_id")
    assert tuple(check.first()) == ("order_date not before signup_date", "orders", "customer_id", 1)
