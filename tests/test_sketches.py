"""Distinct counts, quantiles, samples and differing rows against plain Python."""

import collections
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tallymart.operators import compare, sampling, sketches
from tests.conftest import rows


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the rows share one value; NULLs; a column without values."""
    rng = random.Random(4)
    data = [(i, rng.choice([None, "a", "b"]), 5 if i % 3 == 0 else None if i % 11 == 1 else rng.randrange(700), rng.gauss(0, 1), None) for i in range(4000)]
    return spark.createDataFrame(data, "id int, g string, v int, x double, nothing int").repartition(5).cache()


def test_distinct_counts_without_repeated_rows(numbers):
    columns = {"vs": "v", "xs": "x", "none": "nothing"}
    expected = numbers.groupBy("g").agg(*[F.count_distinct(c).alias(o) for o, c in columns.items()])
    found = sketches.distinct_counts(numbers, ["g"], columns)
    assert rows(found) == rows(expected)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_united_sketches_stay_within_their_bound(spark):
    """Twenty stored sketches of overlapping values, for several numbers of values."""
    for n in (50, 3_000, 200_000):
        df = spark.range(n).select((F.col("id") % 20).alias("day"), "id").unionByName(spark.range(0, n, 3).select(((F.col("id") + 1) % 20).alias("day"), "id"))
        daily = sketches.distinct_sketches(df, ["day"], {"ids": "id"})
        estimate = sketches.united_distinct_counts(daily.withColumn("all", F.lit(1)), ["all"], ["ids"]).first().ids
        assert abs(estimate - n) <= n * sketches.relative_error()


@pytest.mark.parametrize("accuracy", [10, 100, 1000])
def test_quantiles_are_exact(numbers, accuracy):
    at = (0.1, 0.25, 0.5, 0.75, 0.99)
    found = {r.column_name: r for r in sketches.quantiles(numbers, ["v", "x", "nothing"], at, accuracy).collect()}
    for c in ("v", "x"):
        values = sorted(r[0] for r in numbers.select(c).collect() if r[0] is not None)
        assert found[c].n == len(values)
        assert list(found[c])[2:] == [values[max(1, len(values) - math.floor(len(values) - q * len(values))) - 1] for q in at]
    assert found["nothing"].n == 0 and list(found["nothing"])[2:] == [None] * 5


@pytest.mark.parametrize("by", [[], ["g"]])
def test_samples_are_exact_and_do_not_depend_on_the_layout(numbers, by, monkeypatch):
    groups = collections.defaultdict(list)
    for r in numbers.collect():
        groups[tuple(r[c] for c in by)].append((int(hashlib.md5(f"9:{r.id}".encode()).hexdigest()[:15], 16), r.id))
    expected = {i for some in groups.values() for _, i in sorted(some)[: math.ceil(len(some) * 0.03)]}
    for partitions in (1, 60):
        found = sampling.exact_sample(numbers.repartition(partitions), ["id"], 0.03, 9, by)
        assert {r.id for r in found.collect()} == expected and found.columns == numbers.columns
    assert sampling.exact_sample(numbers.limit(0), ["id"], 0.5, 9, by).collect() == []
    assert sampling.exact_sample(numbers, ["id"], 1, 9, by).count() == 4000


def test_differing_rows_are_found_with_their_numbers(spark):
    schema = "k long, t string, x double"
    data = [(k, f"t{k}" if k % 7 else None, float(k)) for k in range(3000)] + [(5, "t5", 5.0)] * 2
    copy = [r for r in data if r[0] != 17] + [(40, "t40", 40.0), (9, "t9", 9.5)]
    copy.remove((9, "t9", 9.0))
    copy.remove((5, "t5", 5.0))
    copy = [(k, "" if k == 21 else t, x) for k, t, x in copy]
    a, b = (spark.createDataFrame(x, schema).repartition(4) for x in (data, copy))
    expected = [(5, "t5", 5.0, 3, 2), (9, "t9", 9.0, 1, 0), (9, "t9", 9.5, 0, 1), (17, "t17", 17.0, 1, 0), (21, None, 21.0, 1, 0), (21, "", 21.0, 0, 1), (40, "t40", 40.0, 1, 2)]
    assert sorted(rows(compare.differing_rows(a, b, ["k"])), key=str) == sorted(expected, key=str)
    assert compare.differing_rows(a, a.repartition(9), ["k"]).isEmpty()
    assert sorted(rows(compare.differing_rows(a.limit(0), spark.createDataFrame([(1, None, None)] * 2, schema), ["k"])), key=str) == [(1, None, None, 0, 2)]
