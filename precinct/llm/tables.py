"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

The operators cut lineage by writing a table there and reading it again: a
lost executor then costs a reread, never a second and possibly different
evaluation, and the planner knows the size of what it reads.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precinct.functions._cols import unused
from precinct.operators.joins import checked_broadcast
from precinct.session import scratch_path

#: Row numbers up to which a list of rows that go is broadcast.
MAX_LOST = 1_000_000
#: Tables that are there yet, by path, in the order they were written.
_there: dict[str, SparkSession] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again. It goes with
    :func:`dropped`, at the end of a :func:`cleared` block, or at the end of the
    driver's process."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _there[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            remove(table.sparkSession, path)
            for known in [p for p in _there if p.rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]]:
                del _there[known]


@contextmanager
def cleared() -> Iterator[None]:
    """Tables written within the block are deleted at its end: for callers that
    have kept what they need of them."""
    before = set(_there)
    try:
        yield
    finally:
        for path in [p for p in _there if p not in before]:
            remove(_there.pop(path), path)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed within the block are deleted when it has
    run, not when the driver happens to collect its garbage: for steps that each
    write a table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@atexit.register
def _clear() -> None:
    for path, spark in _there.items():
        with suppress(Exception):  # the JVM may have gone before
            remove(spark, path)


def without(rows: DataFrame, lost: DataFrame, number: str) -> DataFrame:
    """``rows`` but those whose ``number`` is in ``lost``, a table that is small
    beside them: broadcast behind a check of its size, so that no text moves;
    beyond the check both sides are shuffled."""
    return rows.join(checked_broadcast(lost, MAX_LOST), number, "left_anti").drop(number)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def row_id(df: DataFrame) -> Column:
    """A number for each row of a table, the same whenever the table is read
    again. Numbers follow from the splits of the files, and the splits from the
    cores that are registered when a plan is made, so a lost executor would
    change them: the session's least number of splits is fixed where it is
    unset, at the cores of now."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with :func:`row_id` under a name that it does not have, and the name."""
    name = unused("row", df.columns)
    return df.withColumn(name, row_id(df)), name


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
