"""Every registered query against its SQL twin, and the plans against what must not be in them."""

import datetime
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from tallymart import catalog
from tallymart.operators import profile

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES = catalog.queries()  # the corpus queries are tested next to their operators
ORACLES = catalog.oracle_sql()
# file times have no SQL twin
ROWS_ONLY = {"src_file_audit"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def as_sorted(table):
    return sorted(table, key=lambda row: tuple(str(v) for v in row))


def test_which_queries_have_no_twin():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert not set(ORACLES) - set(QUERIES)


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert ORACLES.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = as_sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = as_sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert found == expected
    text = profile.plan_text(df)
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert step not in text


def test_a_sample_is_repeatable_and_of_the_given_size(spark):
    sample = QUERIES["prof_sample"](spark, "/root/testdata/sf0.01")
    again = QUERIES["prof_sample"](spark, "/root/testdata/sf0.01")
    assert sample.exceptAll(again).isEmpty()
    assert 225 <= sample.count() <= 228  # 1.5 % of 15,000, rounded up in each of three strata


def test_sorted_rows_come_in_order(spark):
    places = [r.place for r in QUERIES["sort_multi"](spark, SF).collect()]
    assert places == list(range(1, len(places) + 1))
    amounts = [(-r.total_amount, r.order_id) for r in QUERIES["topk"](spark, SF).collect()]
    assert amounts == sorted(amounts) and len(amounts) == 10
    amounts = [(r.total_amount, r.order_id) for r in QUERIES["bottomk"](spark, SF).collect()]
    assert amounts == sorted(amounts) and len(amounts) == 5


def test_file_audit_sees_every_table(spark):
    files = {r.file for r in QUERIES["src_file_audit"](spark, SF).collect()}
    assert files == {f"{name}.parquet" for name in TABLES.split()}


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["category", "total_revenue", "units_sold"]
    assert result.count() == 6


def test_pushed_filters_and_read_columns(spark):
    plan = profile.plan_text(QUERIES["flt_between"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    plan = profile.plan_text(QUERIES["rep_frequency_segments"](spark, SF))
    assert "EqualNullSafe(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan


def test_filters_reach_the_scan(spark):
    plan = profile.plan_summary(QUERIES["flt_or"](spark, SF))
    assert plan.pushed == ["Or(EqualTo(o_orderstatus,O),EqualTo(o_orderpriority,1-URGENT))"] and plan.shuffles == 0
    assert plan.columns_read == ["o_orderkey", "o_orderpriority", "o_orderstatus"]
