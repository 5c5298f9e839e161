"""Join of values with a table of intervals that contain them.

Both ends of an interval are included, NULL is no end. Intervals may overlap,
repeat or be empty; a value meets every interval that holds it.

* A table within the size check is an index in the plan: its bounds cut the
  numbers into cells, the cells are sorted, each has the intervals that hold it,
  and a value finds its cell by binary search. No shuffle, no comparison of all
  pairs.
* A larger table is cut into dyadic bands: an interval is at most 2 * 64 bands of
  widths that are powers of two, and a value lies in one band of each width. The
  join is on (width, band), on widths that occur; each pair meets in one band.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.functions._cols import as_col, unused
from precinct.operators.joins import fits

#: Intervals up to which the index is made, as constants of the plan.
MAX_INDEX = 1_000
#: Whole numbers: what an end that is NULL stands for.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


class Cells:
    """The numbers cut at all bounds; of each cell the intervals that hold it."""

    def __init__(self, intervals: list[tuple[int | None, int | None]]):
        ends = [(LOWEST if low is None else low, HIGHEST if high is None else high) for low, high in intervals]
        self.first = sorted({low for low, _ in ends} | {high + 1 for _, high in ends})
        # Before the first bound nothing is held.
        self.held = [[], *[[k for k, (low, high) in enumerate(ends) if low <= at <= high] for at in self.first]]

    def of(self, value: int) -> list[int]:
        return self.held[bisect.bisect_right(self.first, value)]


def _search(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the value: a balanced tree of
    comparisons, as deep as the logarithm of their number."""
    if not bounds:
        return F.lit(0)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        if bounds[middle] > HIGHEST:
            return between(low, middle)
        return F.when(value < F.lit(bounds[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(bounds))


def _indexed(rows: DataFrame, value: Column, table: list, names: list[str], kinds: dict[str, str], low: str, high: str, how: str) -> DataFrame:
    cells = Cells([(r[low], r[high]) for r in table])
    kind = "array<struct<" + ",".join(f"`{n}`:{kinds[n]}" for n in names) + ">>"
    held = [
        F.array(*[F.struct(*[F.lit(table[k][n]).cast(kinds[n]).alias(n) for n in names]) for k in own]).cast(kind)
        for own in cells.held
    ]
    found = unused("found", rows.columns, names)
    place = _search(value, cells.first)
    own = F.when(value.isNotNull(), F.get(F.array(*held), place))
    explode = F.explode_outer if how == "left" else F.explode
    return rows.withColumn(found, explode(own)).select(*rows.columns, *[F.col(found)[n].alias(n) for n in names])


def bands(low: Column, high: Column) -> Column:
    """Structs (width, band) of the dyadic bands that make up low..high. Greedy
    from both ends: an end that is no half of a wider band is a band of its own,
    the rest halves, until the ends have met."""
    none = F.array().cast("array<struct<width:int,band:bigint>>")
    start = F.struct(low.cast("bigint").alias("low"), high.cast("bigint").alias("high"), none.alias("out"))

    def step(state: Column, width: Column) -> Column:
        a, b = state["low"], state["high"]
        odd = lambda x: x.bitwiseAND(F.lit(1).cast("bigint"))
        one = lambda take, x: F.when(take, F.array(F.struct(width.cast("int").alias("width"), x.alias("band")))).otherwise(none)
        left, right = (a <= b) & (odd(a) == 1), (a <= b) & (odd(b) == 0)
        return F.struct(
            F.when(a <= b, F.shiftright(a, 1) + odd(a)).otherwise(a).alias("low"),
            F.when(a <= b, F.shiftright(b, 1) + odd(b) - 1).otherwise(b).alias("high"),
            F.concat(state["out"], one(left, a), one(right, b)).alias("out"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), start, step, lambda s: s["out"])


def _banded(rows: DataFrame, value: str, intervals: DataFrame, names: list[str], low: str, high: str, how: str) -> DataFrame:
    width, band, at = (unused(n, rows.columns, intervals.columns) for n in ("width", "band", "at"))
    ends = F.coalesce(F.col(low), F.lit(LOWEST)), F.coalesce(F.col(high), F.lit(HIGHEST))
    cut = intervals.withColumn(at, F.explode(bands(*ends)))
    cut = cut.select(*names, F.col(at)["width"].alias(width), F.col(at)["band"].alias(band))
    # Widths that occur: at most 64 numbers.
    widths = [r[0] for r in cut.select(width).distinct().collect()]
    each = F.explode(F.array(*[F.lit(w) for w in sorted(widths)]).cast("array<int>"))
    spread = rows.withColumn(width, each).withColumn(
        band, F.call_function("shiftright", F.col(value).cast("bigint"), F.col(width))
    )
    met = spread.join(cut, [width, band]).select(*rows.columns, *names)
    if how == "inner":
        return met
    held = spread.join(cut, [width, band], "left_semi").select(F.col(value)).distinct()
    none = [F.lit(None).cast(intervals.schema[n].dataType).alias(n) for n in names]
    return met.unionByName(rows.join(held, value, "left_anti").select(*rows.columns, *none))


def interval_join(
    rows: DataFrame,
    value: str,
    intervals: DataFrame,
    low: str = "low",
    high: str = "high",
    how: str = "inner",
    max_index: int = MAX_INDEX,
) -> DataFrame:
    """``rows`` with the other columns of each interval that holds ``value``, a
    whole number. ``how="left"`` keeps values that none holds, NULL too, with
    NULLs. The interval table is counted while the plan is built."""
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    names = [c for c in intervals.columns if c not in (low, high)]
    if fits(intervals, max_index):
        table = intervals.collect()  # at most max_index rows
        return _indexed(rows, as_col(value), table, names, dict(intervals.dtypes), low, high, how)
    return _banded(rows, value, intervals, names, low, high, how)
