"""Sums and means of 32-bit numbers that do not depend on the order of rows.

A floating sum depends on how rows fall into tasks. A 32-bit number is a whole
multiple of 2**-149, so its sum can be exact: its digits are cut into limbs of
``LIMB`` bits, every limb is summed as an integer (``sum`` over a bigint, partial
sums and all), and the sums are put together once per group. Any partitioning,
retry or merge of partial results gives the same bits.

A limb is below 2**24, so bigint sums hold 2**39 rows a group; beyond, Spark's
own overflow check ends the query, it never wraps round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.functions._cols import as_col

LIMB = 24
#: Limbs after the point: 7 * 24 bits reach 2**-168, past the last bit of a
#: 32-bit number.
BELOW = 7


def _limbs(value: Column) -> list[Column]:
    """A whole number and ``BELOW`` limbs after the point, each a signed bigint
    of at most 2**24: what rounding the number at a limb's last bit adds to
    rounding it at the last bit of the limb before. Scaling by a power of two,
    rounding, and these differences are exact in a double."""
    rounded = [F.rint(value * F.lit(2.0 ** (LIMB * k))) for k in range(BELOW + 1)]
    later = [r - before * F.lit(float(1 << LIMB)) for before, r in zip(rounded, rounded[1:], strict=False)]
    return [limb.cast("bigint") for limb in [rounded[0], *later]]


def _checked(value: Column) -> Column:
    """The value, or an error while the query runs if it is beyond the limbs."""
    v = value.cast("float").cast("double")
    fault = F.raise_error(F.concat(F.lit("exact sums take values below 2**24 in size, not "), v.cast("string")))
    return F.when(F.abs(v) < F.lit(float(1 << LIMB)), v).when(F.isnan(v) | v.isNull(), v).otherwise(fault.cast("double"))


def exact_sums(col: Column | str) -> Column:
    """Aggregate: the limb sums of the column as one struct (``n``: values that
    are not NULL; ``nan``: those that are not a number; ``l0`` ...)."""
    value = _checked(as_col(col))
    number = F.when(~F.isnan(value), value)
    sums = [F.coalesce(F.sum(limb), F.lit(0).cast("bigint")).alias(f"l{k}") for k, limb in enumerate(_limbs(number))]
    return F.struct(F.count(value).alias("n"), F.count(F.when(F.isnan(value), 1)).alias("nan"), *sums)


def merged(sums: Column | str) -> Column:
    """Aggregate: limb sums of parts, as those of the whole."""
    s = as_col(sums)
    names = ["n", "nan", *[f"l{k}" for k in range(BELOW + 1)]]
    return F.struct(*[F.coalesce(F.sum(s[c]), F.lit(0).cast("bigint")).alias(c) for c in names])


def total_of(sums: Column | str) -> Column:
    """The sum, as the double next to it: limbs are carried upwards until each
    is below 2**24, then added from the last to the first."""
    s = as_col(sums)
    limbs, carry = [], F.lit(0).cast("bigint")
    for k in range(BELOW, 0, -1):
        whole = s[f"l{k}"] + carry
        low = F.pmod(whole, F.lit(1 << LIMB))
        carry = F.shiftright(whole - low, LIMB)
        limbs.append((low, k))
    total = F.lit(0.0)
    for low, k in limbs:
        total = total + low.cast("double") * F.lit(2.0 ** (-LIMB * k))
    total = (s["l0"] + carry).cast("double") + total
    return F.when(s["nan"] > 0, F.lit(float("nan"))).when(s["n"] > 0, total)


def mean_of(sums: Column | str) -> Column:
    """The mean, NULL without values, NaN if one value is not a number."""
    return total_of(sums) / as_col(sums)["n"].cast("double")


def exact_mean_sql(value: str) -> str:
    """The mean of a FLOAT expression as DuckDB SQL: a sum of 128-bit integers,
    exact where the last bit of every value is at least 2**-60."""
    scale = "CAST(1152921504606846976 AS DOUBLE)"
    return f"CAST(sum(CAST(CAST({value} AS DOUBLE) * {scale} AS HUGEINT)) AS DOUBLE) / {scale} / count({value})"


__all__ = ["exact_sums", "merged", "total_of", "mean_of", "exact_mean_sql", "LIMB", "BELOW"]
