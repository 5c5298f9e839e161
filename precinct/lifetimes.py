"""Lifetimes of what a query leaves on the cluster besides its result.

A broadcast of the library lives as long as some plan may use it, which only the
caller knows. Within a :func:`released` block the caller says so: at its end the
broadcasts made in it are destroyed on the driver and on all executors. Results
must be written, collected or checkpointed before. Outside of such a block a
broadcast goes when Spark's cleaner finds that no plan refers to it any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

_open: list[list[Broadcast]] = []


def sent(spark: SparkSession, value) -> Broadcast:
    """A broadcast that the innermost :func:`released` block destroys."""
    made = spark.sparkContext.broadcast(value)
    if _open:
        _open[-1].append(made)
    return made


@contextmanager
def released() -> Iterator[list[Broadcast]]:
    """Destroys the broadcasts made in the block, also after an error. Blocks
    nest; each destroys its own."""
    own: list[Broadcast] = []
    _open.append(own)
    try:
        yield own
    finally:
        _open.remove(own)
        for made in own:
            with suppress(Exception):  # the session may have been stopped in the block
                made.destroy()


@contextmanager
def named_view(df: DataFrame, name: str) -> Iterator[str]:
    """``df`` as a temporary view for the statements built in the block. A name
    that is taken is an error, so no view of the caller's is lost."""
    df.createTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


__all__ = ["sent", "released", "named_view"]
