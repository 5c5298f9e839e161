"""Row filters. Each is a plain predicate on named columns, so Catalyst can
combine them and push them into the scan (``PushedFilters``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.functions.geo import not_null_island
from precinct.functions.temporal import year_range


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """Rows where ``col == value`` (NULL never matches)."""
    return df.where(F.col(col) == F.lit(value))


def filter_year(df: DataFrame, date_col: str, year: int) -> DataFrame:
    """Rows whose date falls in ``year``, as a pushable half-open range."""
    return df.where(year_range(date_col, year))


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every listed column is non-NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def filter_code_range(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    """Rows with ``lo <= col < hi`` (half-open; NULL drops)."""
    return df.where((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))


def filter_null_island(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Drop rows with an unknown position: either coordinate 0 or NULL."""
    return df.where(not_null_island(lat, lon))


def filter_isin(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose ``col`` is in a short literal list.

    For a list that comes out of another query use
    :func:`precinct.operators.joins.semi_join` instead: it stays one plan and
    never passes through the driver.
    """
    return df.where(F.col(col).isin(list(values)))


# Firearm weapon codes are the half-open range [100, 200).
FIREARM_CODES = (100, 200)


def firearm_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents with a known position and a firearm weapon code."""
    lo, hi = FIREARM_CODES
    return filter_code_range(filter_null_island(incidents), "weapon_cd", lo, hi)
