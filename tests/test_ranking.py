import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import ranking
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; some values are NULL."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        value = 500 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(1000)
        data.append((i, value, rng.choice("abc")))
    return spark.createDataFrame(data, "id int, v int, g string").repartition(4).cache()


@pytest.mark.parametrize("order", [["v"], ["-v"], ["g", "-v"], ["-g", "v"]])
def test_rank_equals_the_plain_window(skewed, order):
    plain = Window.orderBy(*ranking.sort_keys(order))
    expected = skewed.withColumn("r", F.rank().over(plain)).withColumn("d", F.dense_rank().over(plain))
    assert rows(ranking.rank(skewed, order, "r", "d")) == rows(expected)


@pytest.mark.parametrize("order", [["v", "id"], ["-v", "id"], ["-g", "v", "-id"]])
def test_row_number_equals_the_plain_window(skewed, order):
    expected = skewed.withColumn("n", F.row_number().over(Window.orderBy(*ranking.sort_keys(order))))
    assert rows(ranking.row_number(skewed, order, "n")) == rows(expected)


@pytest.mark.parametrize("n", [1, 4, 5, 7])
@pytest.mark.parametrize("order", [["v", "id"], ["-v", "id"], ["-g", "-id"]])
def test_ntile_equals_the_plain_window(skewed, n, order):
    expected = skewed.withColumn("t", F.ntile(n).over(Window.orderBy(*ranking.sort_keys(order))))
    assert rows(ranking.ntile(skewed, n, order, "t")) == rows(expected)


def test_positions_are_spread_over_partitions(skewed):
    stored = ranking.positions(skewed, ["v", "id"])
    assert stored.rdd.getNumPartitions() > 1
    assert stored.agg(F.count_distinct("_rn")).first()[0] == 3000


def test_ntile_with_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows(ranking.ntile(df, 5, ["id"], "t")) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("total", [1, 3, 4, 5, 9, 10, 23])
def test_bucket_of_equals_ntile(spark, total):
    df = spark.range(1, total + 1).toDF("id")
    expected = df.withColumn("t", F.ntile(4).over(Window.orderBy("id")))
    assert rows(df.withColumn("t", ranking.bucket_of(F.col("id"), F.lit(total), 4))) == rows(expected)


def test_top_ranked_keeps_ties(spark):
    df = spark.createDataFrame([(1, 9), (2, 9), (3, 8), (4, 7), (5, 7), (6, 1)], "id int, v int")
    assert rows(ranking.top_ranked(df, 3, ["-v"])) == [(1, 9, 1), (2, 9, 1), (3, 8, 3)]
    assert rows(ranking.top_ranked(df, 4, ["-v"])) == [(1, 9, 1), (2, 9, 1), (3, 8, 3), (4, 7, 4), (5, 7, 4)]


@pytest.mark.parametrize("k", [1, 40, 1500, 20_000])
def test_top_ranked_is_the_head_of_all_ranks(skewed, k):
    assert rows(ranking.top_ranked(skewed, k, ["-v"])) == rows(ranking.rank(skewed, ["-v"]).filter(F.col("rank") <= k))


@pytest.mark.parametrize("by", [["v"], ["g"], ["g", "v"]])
def test_row_number_within_groups_equals_the_plain_window(skewed, by):
    expected = skewed.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("g"), "id")))
    assert rows(ranking.row_number_by(skewed, by, ["-g", "id"] if by == ["v"] else ["id"], "n")) == rows(expected)


def test_row_number_within_groups_runs_no_one_task_sort_of_a_group(skewed):
    plan = ranking.row_number_by(skewed, ["v"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan.lower()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-(10**6), 10**6)), min_size=1, max_size=60))
def test_median_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    known = [v for v in values if v is not None]
    expected = float(statistics.median(known)) if known else None
    assert ranking.median(df, "v").first()[0] == expected


def test_median_of_the_largest_values(spark):
    df = spark.createDataFrame([(2**31 - 1,), (2**31 - 3,)], "v int")
    assert ranking.median(df, "v").first()[0] == 2.0**31 - 2


def test_median_where_one_value_dominates(skewed):
    known = [r.v for r in skewed.collect() if r.v is not None]
    assert ranking.median(skewed, "v").first()[0] == statistics.median(known)


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (1,), (None,), (None,), (None,)], "v int")
    assert ranking.mode(df, "v").first()[0] == 1
    assert ranking.mode(df.filter("v is null"), "v").collect() == []


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, v int")
    assert ranking.rank(df, ["v"], "r", "d").collect() == []
    assert ranking.row_number(df, ["v"]).collect() == []
    assert ranking.ntile(df, 4, ["v", "id"], "t").collect() == []
    assert ranking.top_ranked(df, 3, ["v"]).collect() == []
    assert ranking.row_number_by(df, ["v"], ["id"]).collect() == []
    assert ranking.median(df, "v").first()[0] is None
