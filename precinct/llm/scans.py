"""Running sums over sorted rows, without a task that holds a whole group.

Rows are dealt by ranges of (group, order), so a group of any size spreads over
as many partitions as its rows fill. A row's sum is that of its partition so far
and of the partitions before it. Only the first group of a partition can go on
from an earlier one: those offsets are at most one row a partition, which is all
that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.tables import written


def running(df: DataFrame, group: list[str], order: list[str], values: list[str], name: str) -> DataFrame:
    """``df`` with ``before_<value>`` for each of ``values``: its sum over the
    rows of ``group`` (null is one group) that stand before in ascending
    ``order`` (null first). ``df`` is evaluated twice, to find the ranges and to
    deal the rows: give a table. Rows that agree in ``order`` stand in any order."""
    rows = written(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), name)
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("part", *group).agg(*[F.sum(v).alias(v) for v in values])
    going_on = (
        sums.select("part", *group, *[F.sum(v).over(earlier).alias(f"_before_{v}") for v in values])
        .where(F.col(f"_before_{values[0]}").isNotNull())
        .withColumnsRenamed({c: f"_{c}" for c in ("part", *group)})
    )
    same = F.col("part") == F.col("_part")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    within = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return (
        rows.select("*", *[F.coalesce(F.sum(v).over(within), zero).alias(f"before_{v}") for v in values])
        .join(F.broadcast(going_on), same, "left")
        .select(
            *df.columns,
            *[(F.col(f"before_{v}") + F.coalesce(f"_before_{v}", zero)).alias(f"before_{v}") for v in values],
        )
    )


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``rank``, the row's number from 0 within ``group``, as by
    :func:`running`."""
    ones = df.withColumn("one", F.lit(1).cast("bigint"))
    return running(ones, group, order, ["one"], name).withColumnRenamed("before_one", "rank").drop("one")
