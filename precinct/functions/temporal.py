"""Date/time column functions: tolerant timestamp parsing, half-open year
ranges (pushable into scans), and the part-of-day bucket."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.functions._cols import as_col

# The source files write report/occurrence times as
# 12-hour clock text, e.g. "03/01/2015 12:00:00 AM".
SOURCE_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# Parts of the day as ranges of HHMM integers, both ends in;
# what lies between them (460-499, 1160-1199, 1660-1699, 2060-2099) and NULL
# are unclassified. None: no end.
DAY_PARTS = (
    ("morning", 500, 1159),
    ("afternoon", 1200, 1659),
    ("evening", 1700, 2059),
    ("night", 2100, None),
    ("night", None, 459),
)
UNCLASSIFIED = "unclassified"
DAY_PART_LABELS = {part: part for part in (*dict.fromkeys(p for p, _, _ in DAY_PARTS), UNCLASSIFIED)}
# The labels the original reports print, same order as above.
ORIGINAL_DAY_PART_LABELS = {
    "morning": "Πρωί",
    "afternoon": "Απόγευμα",
    "evening": "Βράδυ",
    "night": "Νυχτα",
    "unclassified": "Wrong time stamp",
}


def parse_timestamp(col: Column | str, fmt: str = SOURCE_TS_FORMAT) -> Column:
    """Text → timestamp; unparseable text gives NULL (also with ANSI mode on)."""
    return F.try_to_timestamp(as_col(col), F.lit(fmt))


def parse_date(col: Column | str, fmt: str = SOURCE_TS_FORMAT) -> Column:
    """Text → date through :func:`parse_timestamp`."""
    return parse_timestamp(col, fmt).cast("date")


def year_range(col: Column | str, year: int) -> Column:
    """``year(col) == year`` written as a half-open date range.

    A bare ``year(col) = y`` is opaque to the parquet reader; the range form
    is a pair of comparisons that reach ``PushedFilters`` and row-group stats.
    """
    c = as_col(col)
    return (c >= F.lit(_dt.date(year, 1, 1))) & (c < F.lit(_dt.date(year + 1, 1, 1)))


def day_part(col: Column | str, labels: Mapping[str, str] = DAY_PART_LABELS) -> Column:
    """Bucket an HHMM integer into a part of the day (one CASE expression)."""
    t = as_col(col)
    pairs = [
        (
            (F.lit(True) if low is None else t >= low) & (F.lit(True) if high is None else t <= high),
            F.lit(labels[part]),
        )
        for part, low, high in DAY_PARTS
    ]
    case = F.when(*pairs[0])
    for condition, label in pairs[1:]:
        case = case.when(condition, label)
    return case.otherwise(F.lit(labels[UNCLASSIFIED]))


def day_part_py(t: int | None, labels: Mapping[str, str] = DAY_PART_LABELS) -> str:
    """:func:`day_part` of one number in plain Python."""
    inside = (
        part
        for part, low, high in DAY_PARTS
        if t is not None and (low is None or low <= t) and (high is None or t <= high)
    )
    return labels[next(inside, UNCLASSIFIED)]


DAY_PART_SQL = (
    "CASE "
    + " ".join(
        "WHEN " + " AND ".join([f"{{t}} >= {low}"] * (low is not None) + [f"{{t}} <= {high}"] * (high is not None))
        + f" THEN '{part}'"
        for part, low, high in DAY_PARTS
    )
    + f" ELSE '{UNCLASSIFIED}' END"
)
