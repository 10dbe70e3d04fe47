from datetime import date

import pytest
from pyspark.sql import types as T

from tallymart.session import new_path
from tallymart.streaming.feeds import FeedHistory
from tests.conftest import rows

SCHEMA = T.StructType().add("id", "integer").add("mode", "string").add("qty", "integer").add("note", "string").add("day", "date")
D = [date(2026, 1, d) for d in range(1, 10)]
FILES = [
    [(1, "a", 1, "x", D[0]), (2, "b", 2, "x", D[0]), (3, None, 3, "x", D[0])],
    [(1, "a", 1, "unchanged", D[1]), (2, "b", 9, "y", D[1]), (3, None, 3, "y", D[2]), (4, "n", 4, "y", D[1]), (4, "n", 4, "y", D[1])],
    [(1, "c", 1, "z", D[2]), (1, "a", 1, "z", D[3]), (2, None, 9, "z", D[4])],
]
EXPECTED = [
    (1, "a", 1, "x", D[0], D[2], False), (1, "c", 1, "z", D[2], D[3], False), (1, "a", 1, "z", D[3], None, True),
    (2, "b", 2, "x", D[0], D[1], False), (2, "b", 9, "y", D[1], D[4], False), (2, None, 9, "z", D[4], None, True),
    (3, None, 3, "x", D[0], None, True), (4, "n", 4, "y", D[1], None, True),
]


@pytest.fixture
def history(spark):
    def make():
        return FeedHistory(spark, new_path(spark, "history"), SCHEMA, ["id"], ["mode", "qty"], "day").create()

    return make


def write(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def ordered(found):
    return sorted(found, key=lambda r: (r[0], r[4]))


def test_batches_do_not_matter(spark, history):
    folder = new_path(spark, "feed")
    for data in FILES:
        write(spark, folder, data)
    one, three = history(), history()
    marks = [new_path(spark, "mark") for _ in range(2)]
    one.follow(folder, marks[0])
    three.follow(folder, marks[1], files_per_batch=1)
    assert (one.last_batch(), three.last_batch()) == (1, 3)
    assert ordered(rows(one.versions())) == ordered(rows(three.versions())) == ordered(EXPECTED)
    assert rows(one.late()) == rows(three.late()) == []
    assert sorted(r[0] for r in rows(one.current())) == [1, 2, 3, 4]
    # nothing new: nothing happens
    three.follow(folder, marks[1], files_per_batch=1)
    assert three.last_batch() == 3 and ordered(rows(three.versions())) == ordered(EXPECTED)
    # a batch that the stream repeats is known
    assert not three.apply(spark.createDataFrame(FILES[0], SCHEMA), marks[1], 0)
    # a file that comes later
    write(spark, folder, [(4, "m", 4, "late file", D[7])])
    three.follow(folder, marks[1])
    assert ordered(rows(three.versions()))[-2:] == [(4, "n", 4, "y", D[1], D[7], False), (4, "m", 4, "late file", D[7], None, True)]


def test_lost_checkpoint(spark, history):
    """All files once more under another name: rows of the current versions are known, earlier ones are late, the history stays."""
    folder = new_path(spark, "feed")
    write(spark, folder, FILES[0] + FILES[1])
    kept = history()
    kept.follow(folder, new_path(spark, "mark"))
    before = ordered(rows(kept.versions()))
    kept.follow(folder, new_path(spark, "mark"))
    assert kept.last_batch() == 2 and ordered(rows(kept.versions()))[:1] == before[:1]
    assert {r[0] for r in rows(kept.late())} == {2}
    assert [r[:3] for r in ordered(rows(kept.versions()))] == [r[:3] for r in before]


def test_half_a_batch_is_written_over(spark, history):
    kept = history()
    kept.apply(spark.createDataFrame(FILES[0], SCHEMA), "s", 0)
    spark.createDataFrame([(9, "q", 9, D[0])], "id int, mode string, qty int, effective_date date").write.parquet(f"{kept.path}/open/batch=2")
    spark.createDataFrame([(9, "q", 9, D[0], D[1])], "id int, mode string, qty int, effective_date date, end_date date").write.parquet(f"{kept.path}/closed/batch=2")
    assert {r[0] for r in rows(kept.versions())} == {1, 2, 3}
    kept.apply(spark.createDataFrame(FILES[1], SCHEMA), "s", 1)
    assert {r[0] for r in rows(kept.versions())} == {1, 2, 3, 4}


def test_bad_and_empty_batches(spark, history):
    kept = history()
    assert rows(kept.versions()) == []
    for bad in ([(1, "a", 1, "x", D[0]), (1, "b", 1, "x", D[0])], [(None, "a", 1, "x", D[0])], [(1, "a", 1, "x", None)]):
        with pytest.raises(ValueError, match="repeats a key or has none"):
            kept.apply(spark.createDataFrame(bad, SCHEMA), "s", 0)
    assert kept.last_batch() == 0
    kept.apply(spark.createDataFrame([], SCHEMA), "s", 0)
    assert kept.last_batch() == 1 and rows(kept.versions()) == []


def test_hot_key(spark, history):
    """One key with a thousand versions in a batch."""
    data = [(1, str(k // 2), 0, "x", date.fromordinal(D[0].toordinal() + k)) for k in range(1000)] + [(2, "b", 1, "x", D[0])]
    kept = history()
    kept.apply(spark.createDataFrame(data, SCHEMA), "s", 0)
    found = ordered(rows(kept.versions()))
    assert [(r[1], r[4], r[5]) for r in found[:500]] == [
        (str(k), data[2 * k][4], data[2 * k + 2][4] if k < 499 else None) for k in range(500)
    ] and found[500][:2] == (2, "b")
