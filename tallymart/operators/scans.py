"""Window functions over whole tables and over groups of any size, in one shuffle of the rows.

A window without a partition key moves every row into one task, and one over a hot group nearly so. Here rows are
dealt by cut points of the sort order, taken from a sample, to ranges of about equal size; ordinary windows run within a
range, and their result is stored. What a range has to know of those before it follows from the first and last row of
each (and, for lags, from its last few), and is joined back by range. Nothing is joined by value or by group.

Rows that tie in the order of a rank are dealt by an arbitrary number as well, so a value that a third of the rows share
is spread over ranges; a rank that crosses an edge is put right from the edges.

Orders are lists of column names; a leading ``-`` means descending. NULL is the smallest value. The frame should be a scan
or a stored frame: it is read twice, and the rows of a task that is run again have to be the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallymart.session import few_rows, materialise

SAMPLED = 60  # rows of the sample per range
LEAST = 20  # fewer rows of the sample make no range of their own


def column_of(term: str) -> str:
    return term.lstrip("-")


def sort_keys(order: Sequence[str]) -> list[Column]:
    return [F.col(t[1:]).desc() if t.startswith("-") else F.col(t).asc() for t in order]


def at_or_after(order: Sequence[str], cut: Row) -> Column:
    """Whether a row sorts at or after ``cut``; NULL is the smallest value."""
    reached = F.lit(True)
    for term in reversed(order):
        c, bound = F.col(column_of(term)), cut[column_of(term)]
        if term.startswith("-"):
            later = F.lit(False) if bound is None else c.isNull() | (c < F.lit(bound))
        else:
            later = c.isNotNull() if bound is None else c > F.lit(bound)
        reached = F.coalesce(later, F.lit(False)) | (c.eqNullSafe(F.lit(bound)) & reached)
    return reached


def cut_points(df: DataFrame, order: Sequence[str], ranges: int) -> list[Row]:
    """Keys that part ``df`` into at most ``ranges`` ranges of about equal size, from ``SAMPLED`` rows per range."""
    keys = df.select(*[column_of(t) for t in order])
    sample = keys.withColumn("_u", F.rand(17)).orderBy("_u").limit(SAMPLED * ranges).drop("_u")
    # the sample is bounded, so one task may sort it
    placed = sample.withColumn("_k", F.row_number().over(Window.orderBy(*sort_keys(order)))).withColumn("_n", F.count("*").over(Window.partitionBy(F.lit(1))))
    wanted = F.greatest(F.lit(1), F.least(F.lit(ranges), F.expr(f"_n div {LEAST}")))
    opens = F.floor(F.col("_k") * wanted / F.col("_n")) > F.floor((F.col("_k") - 1) * wanted / F.col("_n"))
    return placed.filter(opens & (F.col("_k") < F.col("_n"))).orderBy("_k").collect()


def _range_of(order: Sequence[str], cuts: Sequence[Row]) -> Column:
    """The number of cut points that a row has reached, by bisection."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(at_or_after(order, cuts[middle - 1]), between(middle, high)).otherwise(between(low, middle - 1))

    return between(0, len(cuts))


def deal(df: DataFrame, order: Sequence[str], ranges: int | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """``df`` (without ``drop``) in partitions by range of ``order``; ``_range`` numbers them in that order."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = cut_points(df, order, ranges)
    return df.withColumn("_range", _range_of(order, cuts)).drop(*drop).repartitionById(len(cuts) + 1, "_range")


def _edges(stored: DataFrame) -> list[tuple[Row, Row]]:
    """The first and the last row of every range that has rows, in order: two rows per range on the driver."""
    found = stored.filter("_at = 1 OR _last").collect()
    first = {r["_range"]: r for r in found if r["_at"] == 1}
    return [(first[r["_range"]], r) for r in sorted((r for r in found if r["_last"]), key=lambda r: r["_range"])]


def _same(a: Row, b: Row, columns: Sequence[str]) -> bool:
    """Whether two rows agree in ``columns`` as a sort does: NULL equals NULL and NaN equals NaN."""
    return all(a[c] == b[c] or (a[c] != a[c] and b[c] != b[c]) for c in columns)


def _by_range(stored: DataFrame, columns: str, offsets: Sequence[tuple]) -> DataFrame:
    """``stored`` with what every range carries over: one broadcast row per range."""
    return stored.join(F.broadcast(few_rows(stored.sparkSession, offsets, f"_range int, {columns}")), "_range")


def rank(df: DataFrame, order: Sequence[str], out: str | None = "rank", dense_out: str | None = None, ranges: int | None = None) -> DataFrame:
    """RANK and DENSE_RANK over the whole table."""
    columns = [column_of(t) for t in order]
    local = Window.partitionBy("_range").orderBy(*sort_keys(order))
    salted = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    dealt = deal(salted, [*order, "_salt"], ranges, drop=["_salt"])
    numbers = {"_rank": F.rank().over(local).cast("long"), "_dense": F.dense_rank().over(local).cast("long"), "_at": F.row_number().over(local).cast("long")}
    stored = materialise(dealt.withColumns(numbers).withColumn("_last", F.lead("_range").over(local).isNull()), "ranks")
    offsets, before, dense_before, begins, previous = [], 0, 0, 0, None
    for first, last in _edges(stored.select("_range", *dict.fromkeys(columns), *numbers, "_last")):
        goes_on = previous is not None and _same(previous, first, columns)
        offsets.append((last["_range"], before, begins if goes_on else before + 1, dense_before - goes_on))
        # where the last value of a range begins: in an earlier one if the range holds nothing else
        begins = begins if goes_on and last["_rank"] == 1 else before + last["_rank"]
        before, dense_before, previous = before + last["_at"], dense_before - goes_on + last["_dense"], last
    placed = _by_range(stored, "_before long, _first_rank long, _dense_before long", offsets)
    wanted = [F.when(F.col("_rank") == 1, F.col("_first_rank")).otherwise(F.col("_before") + F.col("_rank")).alias(out)] if out else []
    wanted += [(F.col("_dense_before") + F.col("_dense")).alias(dense_out)] if dense_out else []
    return placed.select(*df.columns, *wanted)


def _total(a: Column, b: Column) -> Column:
    """The sum of two sums, of which either may be NULL for want of values."""
    return F.coalesce(a + b, a, b)


def scan(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    number: str | None = None,
    running: Mapping[str, str] = {},
    lags: Mapping[str, tuple[str, int]] = {},
    moving: Mapping[str, tuple[str, int]] = {},
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with window columns over the whole table, or over the groups of ``by``, whatever their size.

    ``number`` names the ROW_NUMBER; ``running`` is ``{out: column}`` for the sum of all rows up to this one, ``lags`` ``{out: (column, k)}``
    for the value k rows before, ``moving`` ``{out: (column, k)}`` for the sum of this and the k - 1 rows before. ``order`` has to be
    total within a group. Sums should be of whole numbers or decimals: those of doubles depend on where ranges begin.
    """
    names = list(dict.fromkeys([*running.values(), *(c for c, _ in moving.values())]))
    longest = max([k for _, k in [*lags.values(), *moving.values()]], default=0)
    dealt = deal(df, [*by, *order], ranges)
    whole = Window.partitionBy("_range").orderBy(*sort_keys([*by, *order]))
    group = Window.partitionBy("_range", *by).orderBy(*sort_keys(order))
    so_far = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.withColumn("_at", F.row_number().over(whole).cast("long"))
    local = local.withColumn("_rn", F.row_number().over(group).cast("long") if by else F.col("_at"))
    local = local.withColumns({f"_run{i}": F.sum(c).over(so_far) for i, c in enumerate(names)})
    local = local.withColumns({f"_some{i}": F.count(c).over(so_far) for i, c in enumerate(names)})
    local = local.withColumns({f"_lag{i}": F.lag(c, k).over(group) for i, (c, k) in enumerate(lags.values())})
    local = local.withColumns({f"_mov{i}": F.sum(c).over(group.rowsBetween(1 - k, Window.currentRow)) for i, (c, k) in enumerate(moving.values())})
    stored = materialise(local.withColumn("_last", F.lead("_range").over(whole).isNull()), "scan")

    carried = ["_rn", *[f"_run{i}" for i in range(len(names))], *[f"_some{i}" for i in range(len(names))]]
    offsets, held, previous = [], dict.fromkeys(carried), None
    for first, last in _edges(stored.select("_range", "_at", "_last", *dict.fromkeys([*by, *carried]))):
        goes_on = previous is not None and _same(previous, first, by)
        before = held if goes_on else dict.fromkeys(carried)
        offsets.append((last["_range"], last["_at"], *before.values()))
        # a range that holds nothing but a group from before passes on what that has so far
        before = before if last["_at"] == last["_rn"] else dict.fromkeys(carried)
        held = {c: last[c] if before[c] is None else before[c] if last[c] is None else before[c] + last[c] for c in carried}
        previous = last
    types = [f"before{c} {stored.schema[c].dataType.simpleString()}" for c in carried]
    joined = _by_range(stored, ", ".join(["_rows long", *types]), offsets)
    first = F.col("_at") == F.col("_rn")  # in the first group of its range
    placed = joined.withColumns({c: _total(F.col(c), F.when(first, F.col(f"before{c}"))) for c in carried if c != "_rn"})
    placed = placed.withColumn("_place", _total(F.col("_rn"), F.when(first, F.col("before_rn"))))
    # rows whose lag or frame reaches into an earlier range: at most the first few of a range
    reaches = F.col("_place") > F.col("_rn")
    tails = placed.filter(F.col("_rows") - F.col("_at") < longest)
    for i, (out, (c, k)) in enumerate(lags.items()):
        placed = _looked_up(placed, tails, by, reaches & (F.col("_rn") <= k), k, {"_there": F.col(c)})
        placed = placed.withColumn(f"_lag{i}", F.when(reaches & (F.col("_rn") <= k), F.col("_there")).otherwise(F.col(f"_lag{i}"))).drop("_there")
    for i, (out, (c, k)) in enumerate(moving.items()):
        run, some = f"_run{names.index(c)}", f"_some{names.index(c)}"
        placed = _looked_up(placed, tails, by, reaches & (F.col("_rn") < k), k, {"_there": F.col(run), "_count": F.col(some)})
        within = F.when(F.col(some) > F.coalesce("_count", F.lit(0)), F.col(run) - F.coalesce(F.col("_there"), F.lit(0)))
        placed = placed.withColumn(f"_mov{i}", F.when(reaches & (F.col("_rn") < k), within).otherwise(F.col(f"_mov{i}"))).drop("_there", "_count")
    wanted = [F.col("_place").alias(number)] if number else []
    wanted += [F.col(f"_run{names.index(c)}").alias(out) for out, c in running.items()]
    wanted += [F.col(f"_lag{i}").alias(out) for i, out in enumerate(lags)]
    wanted += [F.col(f"_mov{i}").alias(out) for i, out in enumerate(moving)]
    return placed.select(*df.columns, *wanted)


def _looked_up(rows: DataFrame, tails: DataFrame, by: Sequence[str], need: Column, k: int, values: Mapping[str, Column]) -> DataFrame:
    """``rows`` with ``values`` of the row k places before in its group, taken from ``tails``, where ``need``."""
    keys = [F.col(c).alias(f"_tail_{c}") for c in by]
    there = tails.select(*keys, F.col("_place").alias("_tail_place"), *[v.alias(n) for n, v in values.items()])
    same = [F.col(c).eqNullSafe(F.col(f"_tail_{c}")) for c in by]
    same.append(F.when(need, F.col("_place") - k) == F.col("_tail_place"))
    found = rows.join(F.broadcast(there), reduce(lambda a, b: a & b, same), "left")  # k rows per range at most
    return found.drop("_tail_place", *[f"_tail_{c}" for c in by])
