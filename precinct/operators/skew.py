"""Equi-join where few keys hold much of one side.

1. *Summary.* Frequent keys are found with a mergeable summary (Misra-Gries): a
   task keeps at most ``size`` counters, and the counters of tasks are added in one
   aggregation. Keys above a small share are never missed; the summary decides
   only how rows are spread, so any summary, also an empty one, gives the same
   result.
2. *Salt.* Rows of a heavy key are numbered off into parts of a ``GRAIN``-th of
   a task each, many enough to fall evenly into tasks by hash. Rows of other keys
   keep one part.
3. *Join.* Only the dimension rows of heavy keys are repeated, once a part; the
   join is on (key, part), under the planner's own strategy.

The keys' hashes of the summary, at most ``size`` numbers, are all that goes
through the driver and into the plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import precinct
from precinct.functions._cols import unused
from precinct.operators.joins import hinted

#: Counters of a summary, at least: keys with over a 1,000th of the rows are found.
SIZE = 2_000
#: Parts that a task's share of rows is cut into.
GRAIN = 16


class Frequent:
    """At most ``size`` counters of a stream's keys: a counter is what its key
    has, less at most rows / ``size``; keys without one have no more than that."""

    def __init__(self, size: int):
        self.size, self.rows = size, 0
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        both, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, at, np.concatenate([self.counts, counts]))
        if len(both) > self.size:
            # The largest count that gets no counter is taken from all others.
            least = np.partition(total, -self.size - 1)[-self.size - 1]
            both, total = both[total > least], total[total > least] - least
        self.keys, self.counts = both, total


def key_hash(keys: Sequence[str]) -> Column:
    """The number that stands for a key; keys with equal numbers share their
    parts, which is as right."""
    return F.xxhash64(*keys)


def frequent_keys(df: DataFrame, keys: Sequence[str], size: int = SIZE) -> tuple[dict[int, int], int]:
    """({hash of a key: rows it has at least}, number of rows) of the keys that
    hold over 2 / ``size`` of the rows, and of some others, at most ``size``.

    One scan of the key columns. A task hands on the keys that hold 1 / ``size``
    of its own rows; their counts meet in one aggregation, so no task and no
    driver sees all summaries. What a task leaves out of a key, by its counters
    and by its threshold, is at most 2 / ``size`` of its rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Frequent(size)
        for batch in batches:
            own.add(*np.unique(batch.column(0).to_numpy(), return_counts=True))
            own.rows += batch.num_rows
        often = own.counts * size >= own.rows
        for keys, counts in ((own.keys[often], own.counts[often]), ([None], [own.rows])):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["key", "n"])

    cloudpickle.register_pickle_by_value(precinct)  # for the time of pickling
    try:
        found = df.select(key_hash(keys).alias("key")).mapInArrow(counted, "key bigint, n bigint")
    finally:
        cloudpickle.unregister_pickle_by_value(precinct)
    # The null key carries the numbers of rows; it is the largest.
    top = found.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.col("key").isNotNull()).limit(size + 1)
    rows = {r["key"]: r["n"] for r in top.collect()}
    total = rows.pop(None, 0)
    return rows, total


def skewed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hint: str | None = None,
    partitions: int | None = None,
    grain: int = GRAIN,
) -> DataFrame:
    """Inner join on ``keys`` whose left side may have most of its rows on few
    keys. Columns as of ``left.join(right, keys)``. Rows of a heavy key are
    spread by a hash of all their columns, so equal rows stay together, and a
    lost task makes the same rows again. ``partitions``: tasks that the join is
    to fill, by default the session's shuffle partitions."""
    spark, keys = left.sparkSession, list(keys)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts, rows = frequent_keys(left, keys, max(SIZE, 4 * partitions))
    share = rows / (partitions * grain)  # rows of a part
    heavy = [(key, min(int(n // share) + 1, partitions * grain)) for key, n in counts.items() if n >= 2 * share]
    key, parts, part = (unused(n, left.columns, right.columns) for n in ("key", "parts", "part"))
    # At most 4 * partitions + SIZE rows: a bound that does not grow with the data.
    known = F.broadcast(spark.createDataFrame(heavy, f"`{key}` bigint, `{parts}` bigint"))
    each = F.coalesce(F.col(parts), F.lit(1))
    spread = (
        left.withColumn(key, key_hash(keys))
        .join(known, key, "left")
        .withColumn(part, F.pmod(F.xxhash64(F.lit(1), *left.columns), each))
        .select(*left.columns, part)
    )
    repeated = (
        right.withColumn(key, key_hash(keys))
        .join(known, key, "left")
        .withColumn(part, F.explode(F.sequence(F.lit(0).cast("bigint"), each - 1)))
        .select(*right.columns, part)
    )
    rest = [c for c in right.columns if c not in keys]
    return spread.join(hinted(repeated, hint), [*keys, part]).select(*keys, *[c for c in left.columns if c not in keys], *rest)


__all__ = ["Frequent", "frequent_keys", "skewed_join", "key_hash"]
