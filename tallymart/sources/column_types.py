"""Column types of text columns, found from all rows in one pass.

For every column one aggregate counts how many values each type and each date format admits, next to the digits
seen. A type is taken only if it admits every value, so a single value settles whether a column of ``03/04/2024`` is
day first or month first; if none does, the column is marked as ambiguous. No sample, and no second read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date spellings, the likelier one first where two fit.
DATES = ("yyyy-M-d", "yyyy/M/d", "d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "M-d-yyyy", "d.M.yyyy")
TIMESTAMPS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")
TRUTHS = ("true", "false", "yes", "no")
WHOLE = r"^[+-]?(0|[1-9]\d*)$"
DECIMAL = r"^[+-]?(0|[1-9]\d*)(\.\d+)?$"
DOUBLE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)$"
SHAPES = {"-": r"^\d{1,2}-\d{1,2}-\d{4}$", "/": r"^\d{1,2}/\d{1,2}/\d{4}$", ".": r"^\d{1,2}\.\d{1,2}\.\d{4}$"}
YEAR_FIRST = {"-": r"^\d{4}-\d{1,2}-\d{1,2}$", "/": r"^\d{4}/\d{1,2}/\d{1,2}$"}


def _parsed(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def _is_date(text: Column, pattern: str) -> Column:
    """Whether a text is a day of the calendar in this spelling; the shape keeps the parser to likely texts."""
    sep = next(c for c in pattern if c in "-/.")
    shape = (YEAR_FIRST if pattern.startswith("y") else SHAPES)[sep]
    return F.when(text.rlike(shape), _parsed(text, pattern).isNotNull()).otherwise(False)


def _is_time(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d$"), _parsed(text, pattern).isNotNull()).otherwise(False)


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: column_name, n_values, n_blank, type, format, ambiguous.

    NULL and blank texts are no values; a column without any is a string. A number with a leading zero (a code)
    makes its column a string. Numbers of more than 38 digits are doubles if they have a fraction, else strings.
    """
    names = list(columns or df.columns)

    def counts(i: int, name: str) -> list[Column]:
        text = F.trim(F.col(f"`{name}`"))
        value = F.when(text != "", text)
        digits = F.regexp_replace(value, r"^[+-]", "")
        return [
            F.count(value).alias(f"n{i}"),
            F.count_if(value.rlike(WHOLE)).alias(f"whole{i}"),
            F.count_if(value.rlike(DECIMAL)).alias(f"decimal{i}"),
            F.count_if(value.rlike(DECIMAL) | value.rlike(DOUBLE)).alias(f"double{i}"),
            F.max(F.when(value.rlike(DECIMAL), F.length(F.substring_index(digits, ".", 1)))).alias(f"left{i}"),
            F.max(F.when(value.rlike(DECIMAL), F.length(digits) - F.length(F.substring_index(digits, ".", 1)) - 1)).alias(f"right{i}"),
            F.count_if(F.lower(value).isin(*TRUTHS)).alias(f"truth{i}"),
            *[F.count_if(_is_date(value, p)).alias(f"date{i}_{k}") for k, p in enumerate(DATES)],
            *[F.count_if(_is_time(value, p)).alias(f"time{i}_{k}") for k, p in enumerate(TIMESTAMPS)],
        ]

    def verdict(i: int, name: str) -> Column:
        n, left, right = F.col(f"n{i}"), F.coalesce(f"left{i}", F.lit(0)), F.greatest(F.coalesce(f"right{i}", F.lit(0)), F.lit(0))
        fits = lambda what: (n > 0) & (F.col(f"{what}{i}") == n)
        date_fits = [(n > 0) & (F.col(f"date{i}_{k}") == n) for k in range(len(DATES))]
        time_fits = [(n > 0) & (F.col(f"time{i}_{k}") == n) for k in range(len(TIMESTAMPS))]
        pattern = F.coalesce(*[F.when(f, F.lit(p)) for f, p in zip([*date_fits, *time_fits], [*DATES, *TIMESTAMPS], strict=True)])
        kind = (
            F.when(fits("whole") & (left <= 9), "int")
            .when(fits("whole") & (left <= 18), "bigint")
            .when(fits("whole") & (left <= 38), F.concat(F.lit("decimal("), left.cast("string"), F.lit(",0)")))
            .when(fits("decimal") & (left + right <= 38), F.concat(F.lit("decimal("), (left + right).cast("string"), F.lit(","), right.cast("string"), F.lit(")")))
            .when(fits("double") & ~fits("whole"), "double")
            .when(fits("truth"), "boolean")
            .when(F.greatest(*date_fits), "date")
            .when(F.greatest(*time_fits), "timestamp")
            .otherwise("string")
        )
        several = sum((f.cast("int") for f in date_fits), F.lit(0)) > 1
        return F.struct(
            F.lit(name).alias("column_name"), n.alias("n_values"), (F.col("n_rows") - n).alias("n_blank"), kind.alias("type"),
            pattern.alias("format"), several.alias("ambiguous"),
        )

    one_row = df.agg(F.count("*").alias("n_rows"), *[c for i, name in enumerate(names) for c in counts(i, name)])
    return one_row.select(F.inline(F.array(*[verdict(i, name) for i, name in enumerate(names)])))


def with_types(df: DataFrame, types: DataFrame) -> DataFrame:
    """``df`` with its text columns in the types of ``infer_types``; one row per column comes to the driver."""
    found = {r.column_name: r for r in types.collect()}

    def typed(name: str) -> Column:
        column, r = F.col(f"`{name}`"), found.get(name)
        if r is None or r.type == "string":
            return column.alias(name)
        value = F.when(F.trim(column) != "", F.trim(column))
        if r.type in ("date", "timestamp"):
            return _parsed(value, r.format).cast(r.type).alias(name)
        return value.cast(r.type).alias(name)

    return df.select(*[typed(name) for name in df.columns])
