"""Random tables against plain Python."""

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallymart.operators import clean, joins, merge, profile
from tests.conftest import rows

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.one_of(st.none(), st.integers(0, 3))
tables = st.dictionaries(st.integers(0, 12), st.tuples(values, values), max_size=10)
SCHEMA = "id int, a int, b int"


def frame(spark, table):
    return spark.createDataFrame([(k, *v) for k, v in table.items()], SCHEMA)


@few
@given(tables, tables)
def test_upsert_is_a_dictionary_update(spark, target, feed):
    merged = merge.upsert(frame(spark, target), frame(spark, feed), ["id"])
    assert {r.id: (r.a, r.b) for r in merged.collect()} == {**target, **feed}
    assert merged.count() == len({**target, **feed})


@few
@given(tables, st.lists(tables, min_size=1, max_size=2))
def test_type_two_history(spark, target, feeds):
    history = merge.scd2_init(frame(spark, target), date(2026, 1, 1))
    current = dict(target)
    versions = {k: [v] for k, v in target.items()}
    for month, feed in enumerate(feeds, 2):
        history = merge.scd2_apply(history, frame(spark, feed), ["id"], ["a", "b"], date(2026, month, 1))
        for k, v in feed.items():
            if k not in current or current[k] != v:
                versions.setdefault(k, []).append(v)
            current[k] = v
    found = history.collect()
    assert {r.id: (r.a, r.b) for r in found if r.is_current} == current
    for k, expected in versions.items():
        own = sorted((r for r in found if r.id == k), key=lambda r: r.effective_date)
        assert [(r.a, r.b) for r in own] == expected
        for earlier, later in zip(own, own[1:]):
            assert earlier.end_date == later.effective_date and not earlier.is_current
        assert own[-1].end_date is None and own[-1].is_current
    assert len(found) == sum(len(v) for v in versions.values())


@few
@given(st.lists(st.tuples(values, st.integers(0, 9), values), max_size=20))
def test_keep_first_and_duplicates(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v int")
    first = {}
    for k, o, v in sorted(data, key=lambda r: (r[1], r[2] is not None, r[2] or 0)):
        first.setdefault(k, (k, o, v))
    assert set(rows(clean.keep_first(df, ["k"], ["o", "v"]))) == set(first.values())
    assert tuple(profile.duplicate_row_count(df).first()) == (len(data), len(set(data)), len(data) - len(set(data)))


@few
@given(tables, st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), values), max_size=15))
def test_left_join(spark, parents, children):
    child = spark.createDataFrame(children, "id int, c int")
    parent = frame(spark, parents)
    assert rows(joins.keep_all_parents(parent, child, "id")) == rows(parent.join(child, "id", "left"))
