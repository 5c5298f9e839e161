"""Arrow-batched Python inside tasks."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import pickle
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import precinct

#: Rows and bytes a task gathers before it hands a batch on.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: bool = False
) -> DataFrame:
    """``df.mapInArrow`` with this package's functions sent by value, so that
    executors need not have it installed. ``keeps``: ``fn`` uses
    :func:`worker_wide`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return tidied(fn, batches, keeps)

    cloudpickle.register_pickle_by_value(precinct)
    try:
        return df.mapInArrow(run, schema)
    finally:
        cloudpickle.unregister_pickle_by_value(precinct)


def arrow_column(fn: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind: str, column: Column) -> Column:
    """A column of type ``kind`` that ``fn`` makes of the arrays of another: the
    rest of a row stays in the JVM. ``fn`` gives as many values as it takes."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tidied(fn, arrays, False)

    cloudpickle.register_pickle_by_value(precinct)
    try:
        # Said to be nondeterministic, so that it is evaluated once a row where
        # a condition and the result both use it.
        return F.arrow_udf(run, kind).asNondeterministic()(column)
    finally:
        cloudpickle.unregister_pickle_by_value(precinct)


def values_of(arrays: Iterator[pa.Array], size: int = 256) -> Iterator[list]:
    """The values of the arrays, a slice at a time."""
    for array in arrays:
        for at in range(0, len(array), size):
            yield array.slice(at, size).to_pylist()


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema))


def _memory() -> dict:
    """What this Python worker keeps between tasks."""
    return sys.modules.setdefault("precinct_worker_memory", types.ModuleType("precinct_worker_memory")).__dict__


def worker_wide(make: Callable, *args):
    """``make(*args)``, kept by this Python worker for the tasks that follow. One
    object is kept at a time."""
    kept = _memory()
    key = make.__qualname__, hashlib.sha256(pickle.dumps(args)).digest()
    if kept.get("key") != key:
        kept.pop("object", None)
        kept["key"], kept["object"] = key, make(*args)
        gc.set_threshold(100_000, 50, 100)  # what is kept holds no cycles
    return kept["object"]


def tidied(fn: Callable[[Iterator], Iterator], batches: Iterator, keeps: bool) -> Iterator:
    """``fn(batches)``. A task that does not ``keep`` anything drops what the
    worker kept: workers outlive stages, and what one stage remembers must not
    stay beside what later ones need. Memory that is free goes back."""
    if not keeps and "object" in _memory():
        forget()
    yield from fn(batches)
    rest = getattr(_memory().get("object"), "rest", None)
    if rest is not None:  # an idle worker keeps the smaller part only
        rest()
    trim()


def forget() -> None:
    kept = _memory()
    kept.pop("object", None)
    kept.pop("key", None)
    gc.collect()


def trim() -> None:
    """Give back what the allocators hold."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


class Batches:
    """Rows gathered into record batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int = 64) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= BATCH_ROWS or self.bytes >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema
            )
        self.rows, self.bytes = [], 0


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[tuple]:
    """The rows of the batches, a slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield from zip(*[c.to_pylist() for c in part.columns], strict=True)
