"""Geographic column functions: great-circle distance and the
"null island" test, as native expressions (whole-stage codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.functions._cols import as_col

# Fixed value: mean Earth radius in km used by the distance reports.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in km between two (lat, lon) points in degrees.

    ``1 - a`` is clamped at 0: rounding can push ``a`` a hair above 1 for
    antipodal points, where a square root of a negative number would be NaN.
    """
    p1, l1 = F.radians(as_col(lat1)), F.radians(as_col(lon1))
    p2, l2 = F.radians(as_col(lat2)), F.radians(as_col(lon2))
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    c = F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - a)))
    return F.lit(EARTH_RADIUS_KM) * c


def haversine_km_f32(lat1, lon1, lat2, lon2) -> Column:
    """:func:`haversine_km` rounded to 32-bit float, as the reports average it."""
    return haversine_km(lat1, lon1, lat2, lon2).cast("float")


def known(col: Column | str) -> Column:
    """True for a finite number; NULL, NaN and infinities are unknown."""
    c = as_col(col)
    return c.isNotNull() & (F.abs(c) < F.lit(float("inf")))


def not_null_island(lat: Column | str = "lat", lon: Column | str = "lon") -> Column:
    """True when both coordinates are known and non-zero."""
    la, lo = as_col(lat), as_col(lon)
    finite = [F.abs(c) < F.lit(float("inf")) for c in (la, lo)]
    return (la != F.lit(0.0)) & (lo != F.lit(0.0)) & finite[0] & finite[1]


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The same distance as SQL text valid in both Spark SQL and DuckDB."""
    a = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    return (
        f"(CAST(6371.0 AS DOUBLE) * 2 * atan2(sqrt({a}),"
        f" sqrt(greatest(CAST(0 AS DOUBLE), 1 - ({a})))))"
    )
