"""Window functions over ranges against plain windows, and that no range is much larger than its share."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import scans
from tests.conftest import rows

RANGES = 9


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one group and one value; groups of one row; NULL groups and amounts."""
    rng = random.Random(3)
    data = []
    for i in range(4000):
        group = "hot" if i % 3 == 0 else None if i % 40 == 1 else f"g{rng.randrange(300)}"
        value = 7 if i % 3 == 1 else None if i % 50 == 1 else rng.randrange(500)
        data.append((i, group, value, rng.choice([None, 1, 2, 3])))
    return spark.createDataFrame(data, "id int, g string, v int, rare int").repartition(4).cache()


@pytest.mark.parametrize("by", [[], ["g"], ["v"], ["g", "rare"]])
@pytest.mark.parametrize("order", [["id"], ["-v", "id"]])
def test_scan_equals_plain_windows(hot, by, order):
    w = Window.partitionBy(*by).orderBy(*scans.sort_keys(order))
    expected = hot.select(
        "*", F.row_number().over(w).cast("long"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.sum("rare").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        F.lag("v", 1).over(w), F.lag("g", 5).over(w), F.sum("v").over(w.rowsBetween(-3, 0)), F.sum("rare").over(w.rowsBetween(-1, 0)), F.sum("v").over(w.rowsBetween(-799, 0)),
    )
    found = scans.scan(
        hot, order, by, "n", {"run": "v", "run_rare": "rare"}, {"lag1": ("v", 1), "lag5": ("g", 5)}, {"last4": ("v", 4), "last2": ("rare", 2), "last800": ("v", 800)}, ranges=RANGES
    )
    assert rows(found) == rows(expected)


@pytest.mark.parametrize("order", [["v"], ["-v"], ["-rare", "v"], ["rare"]])
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_ranks_across_many_edges(hot, order, ranges):
    """Values with more rows than a range, so that a tie goes on over several."""
    w = Window.orderBy(*scans.sort_keys(order))
    expected = hot.select("*", F.rank().over(w).cast("long"), F.dense_rank().over(w).cast("long"))
    assert rows(scans.rank(hot, order, "r", "d", ranges)) == rows(expected)


def test_no_range_is_much_larger_than_its_share(hot):
    for order in (["g", "id"], ["-v", "id"]):
        dealt = scans.deal(hot, order, RANGES)
        sizes = [r[1] for r in dealt.groupBy("_range").count().collect()]
        assert dealt.rdd.getNumPartitions() == len(sizes) == RANGES
        assert max(sizes) < 1.5 * 4000 / RANGES
    # a value of a third of the rows, in an order in which they tie
    salted = hot.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    sizes = [r[1] for r in scans.deal(salted, ["v", "_salt"], RANGES).groupBy("_range").count().collect()]
    assert max(sizes) < 1.5 * 4000 / RANGES


def test_one_shuffle_of_the_rows(spark):
    """Windows by range need no exchange of their own."""
    rows_ = spark.range(5000).withColumn("v", F.col("id") % 7)
    w = Window.partitionBy("_range").orderBy("id")
    dealt = scans.deal(rows_, ["id"], RANGES).withColumn("n", F.row_number().over(w)).withColumn("s", F.sum("v").over(w))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_small_and_empty_tables(spark):
    empty = spark.createDataFrame([], "id int, g string, v int")
    one = spark.createDataFrame([(1, "a", 5)], "id int, g string, v int")
    assert scans.scan(empty, ["id"], ["g"], "n", {"s": "v"}, {"l": ("v", 1)}, {"m": ("v", 2)}).collect() == []
    assert rows(scans.scan(one, ["id"], [], "n", {"s": "v"}, {"l": ("v", 1)}, {"m": ("v", 2)})) == [(1, "a", 5, 1, 5, None, 5)]
    assert scans.rank(empty, ["v"]).collect() == [] and rows(scans.rank(one, ["v"], "r", "d")) == [(1, "a", 5, 1, 1)]
