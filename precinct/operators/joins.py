"""Joins: strategy hints, size-checked broadcast, coordinate / ZIP / area
joins and the semi-join that replaces "collect a list, then filter IN".

Broadcasting is only done behind a check: :func:`checked_broadcast` counts the
rows and bytes of the candidate side and hints the broadcast only when the side
fits; otherwise the plan is left to the planner
and AQE (sort-merge or shuffled-hash, with skew splitting). Sides whose size is
bounded by construction (a top-k result) are broadcast directly and say why.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precinct.functions.text import zip5

# Strategy names accepted by :func:`hinted`; the last three are Spark join
# hints, "broadcast" goes through the size check.
JOIN_HINTS = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")

# Default bounds for a broadcast side (dimension tables are far below both).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _row_bytes(df: DataFrame):
    """Column expression: an upper bound of one row's payload in bytes
    (fixed widths, plus the byte length of strings / binaries)."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = _FIXED_WIDTH.get(type(f.dataType))
        if width is not None:
            total = total + F.lit(width + 8)
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + F.lit(16)
        else:  # nested values: measure their JSON text
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    return total


def bounded_count(
    df: DataFrame, max_rows: int, max_bytes: int | None = DEFAULT_BROADCAST_BYTES
) -> int | None:
    """Row count of ``df`` if it has at most ``max_rows`` rows and (when
    ``max_bytes`` is given) at most ``max_bytes`` of payload, else ``None``.

    One aggregation, combined map-side: a row per task reaches the last one.
    """
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    n, size = row["n"], row["b"] or 0
    if n > max_rows or (max_bytes is not None and size > max_bytes):
        return None
    return n


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
         max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` is within both bounds (see :func:`bounded_count`)."""
    return bounded_count(df, max_rows, max_bytes) is not None


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int | None = DEFAULT_BROADCAST_BYTES, within: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` if ``df`` is within the row and byte bounds, else
    ``df``, with a warning: its join is left to the planner and AQE.

    ``within`` is a table that ``df`` is derived from and cannot outgrow, in rows
    or bytes. Its size is looked at first: if it is within the bounds, ``df`` is
    not evaluated for the check.
    """
    if (within is not None and fits(within, max_rows, max_bytes)) or fits(df, max_rows, max_bytes):
        return F.broadcast(df)
    warnings.warn(f"no broadcast: more than {max_rows} rows or {max_bytes} bytes", stacklevel=2)
    return df


def hinted(
    df: DataFrame, hint: str | None, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, within: DataFrame | None = None
) -> DataFrame:
    """Apply a join-strategy hint to the build side ``df``.

    ``None`` leaves the choice to the planner and AQE; ``"broadcast"`` is
    size-checked (:func:`checked_broadcast`);
    ``"merge"``, ``"shuffle_hash"``, ``"shuffle_replicate_nl"``
    force sort-merge, shuffled-hash, and cartesian-with-filter respectively
    (the last is quadratic; a study setting for small inputs only).
    """
    if hint is None:
        return df
    h = hint.lower()
    if h == "broadcast":
        return checked_broadcast(df, max_broadcast_rows, within=within)
    if h in JOIN_HINTS:
        return df.hint(h)
    raise ValueError(f"unknown join hint {hint!r}; expected one of {JOIN_HINTS}")


def join_coords_expr(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("lat", "lon"), hint: str | None = None
) -> DataFrame:
    """Inner join on equal coordinates written as an explicit predicate.

    The right side's key columns are dropped after the join, so the result
    has the same columns as :func:`join_coords_using`.
    """
    renamed = {k: f"_r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(renamed.get(c, c)) for c in right.columns])
    r = hinted(r, hint)
    cond = None
    for k in keys:
        term = F.col(k) == F.col(renamed[k])
        cond = term if cond is None else cond & term
    return left.join(r, cond, "inner").drop(*renamed.values())


def join_coords_using(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("lat", "lon"), hint: str | None = None
) -> DataFrame:
    """Inner join on equal coordinates, USING form (one copy of the keys)."""
    return left.join(hinted(right, hint), list(keys), "inner")


def with_zip_code(df: DataFrame, zip_col: str = "zip", out: str = "zip_code") -> DataFrame:
    """Add the normalised 5-digit int ZIP (ZIP+4 and text accepted)."""
    return df.withColumn(out, zip5(zip_col))


def join_zip_income(df: DataFrame, income: DataFrame, hint: str | None = None) -> DataFrame:
    """Inner join on the normalised int ``zip_code``."""
    return df.join(hinted(income, hint), "zip_code", "inner")


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """``df``, or an error while it runs if two rows have the same ``key``
    (which would multiply the rows of a join). One row per key is left, so
    this is for dimensions that are meant to be unique."""
    others = [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    fault = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    return one.where(F.when(F.col("_n") > 1, fault.cast("boolean")).otherwise(F.lit(True))).select(*df.columns)


def join_area_station(incidents: DataFrame, stations: DataFrame, hint: str | None = "broadcast") -> DataFrame:
    """Each incident with the station responsible for its area (area = prec).

    Stations are a small dimension: by default they are broadcast after the
    size check, so the fact is joined map-side with no shuffle.
    """
    s = hinted(unique_by(stations, "prec"), hint, within=stations)
    return incidents.join(s, incidents["area"] == s["prec"], "inner")


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str], bounded: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (``left_semi``).

    ``bounded=True`` states that ``keys`` is small by construction (a top-k
    result with a checked k) and broadcasts it directly; otherwise it is
    size-checked.
    """
    k = F.broadcast(keys) if bounded else checked_broadcast(keys)
    return df.join(k, on, "left_semi")
