from datetime import date, datetime
from decimal import Decimal

from tallymart.operators import profile
from tallymart.sources.column_types import infer_types, with_types
from tests.conftest import rows

COLUMNS = {
    # values of a column, its type, its format, whether two formats fit
    "whole": (["1", " -22 ", "", None], "int", None, False),
    "big": (["12345678901", "1", "2", "3"], "bigint", None, False),
    "huge": (["1" * 30, "1", "2", "3"], "decimal(30,0)", None, False),
    "too_long": (["1" * 39, "1", "2", "3"], "string", None, False),
    "money": (["12.50", "3", "-100.125", None], "decimal(6,3)", None, False),
    "science": (["1e3", "2.5", "3", None], "double", None, False),
    "code": (["007", "12", "13", "14"], "string", None, False),
    "truth": (["true", "FALSE", "yes", None], "boolean", None, False),
    "day_first": (["03/04/2024", "4/5/2024", "25/12/2023", None], "date", "d/M/yyyy", False),
    "month_first": (["03/04/2024", "4/5/2024", "12/25/2023", None], "date", "M/d/yyyy", False),
    "either": (["03/04/2024", "4/5/2024", "", None], "date", "d/M/yyyy", True),
    "neither": (["13/04/2024", "4/25/2024", "", None], "string", None, False),
    "no_day": (["2024-02-30", "2024-02-28", None, None], "string", None, False),
    "iso": (["2024-02-29", "2024-2-1", None, None], "date", "yyyy-M-d", False),
    "time": (["2024-02-29 10:11:12", None, None, None], "timestamp", "yyyy-MM-dd HH:mm:ss", False),
    "empty": (["", " ", None, None], "string", None, False),
    "odd.name": (["x", "1", "2", "3"], "string", None, False),
}


def frame(spark):
    data = list(zip(*[c[0] for c in COLUMNS.values()], strict=True))
    return spark.createDataFrame(data, ", ".join(f"`{name}` string" for name in COLUMNS))


def test_types(spark):
    found = {r.column_name: r for r in infer_types(frame(spark)).collect()}
    assert {k: (r.type, r.format, r.ambiguous) for k, r in found.items()} == {k: c[1:] for k, c in COLUMNS.items()}
    blank = {k: sum(not (v or "").strip() for v in c[0]) for k, c in COLUMNS.items()}
    assert {k: r.n_blank for k, r in found.items()} == blank
    assert all(r.n_values + r.n_blank == 4 for r in found.values())


def test_one_read(spark, tmp_path):
    frame(spark).select("whole", "iso").write.csv(f"{tmp_path}/t", header=True)
    assert profile.plan_text(infer_types(spark.read.csv(f"{tmp_path}/t", header=True))).count("FileScan csv") == 1


def test_typed_rows(spark):
    df = frame(spark)
    first = with_types(df, infer_types(df)).first().asDict()
    assert first["whole"] == 1 and first["money"] == Decimal("12.500") and first["science"] == 1000.0 and first["truth"] is True
    assert first["day_first"] == date(2024, 4, 3) and first["month_first"] == date(2024, 3, 4) and first["code"] == "007"
    assert first["time"] == datetime(2024, 2, 29, 10, 11, 12)


def test_empty_table(spark):
    assert {tuple(r)[1:4] for r in rows(infer_types(frame(spark).limit(0)))} == {(0, 0, "string")}
