"""Reports over a growing folder of files, from partial results kept per file.

A store holds, for every source file, its partial results under the report's
keys: counts and exact sums, which merge by addition. An update lists the files,
reads only those that the store lacks or that have changed since, and appends
their partial results. The report then merges the store, whose size follows from
files and keys, not from rows.

A file is known by its path, length and time of change. One that has changed gets
a new generation, and only the newest generation of a file counts; one that is
gone no longer counts. Partial results of a generation are written in one job
before its manifest rows are: after a crash between the two, the generation is
made again, and without manifest rows the first attempt's results count nowhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "path string, length bigint, changed bigint, generation string"


@dataclass
class Store:
    """Partial results in ``folder``: ``read`` makes rows of paths, ``keys`` and
    ``partials`` say what is kept of them for each file."""

    spark: SparkSession
    folder: str
    read: Callable[[SparkSession, list[str]], DataFrame]
    keys: Sequence[Column]
    partials: Sequence[Column]

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def manifest(self) -> DataFrame:
        """The newest generation of each file that was read."""
        path = f"{self.folder}/manifest"
        if not self._exists(path):
            return self.spark.createDataFrame([], _MANIFEST)
        rows = self.spark.read.schema(_MANIFEST + ", stamp bigint").parquet(path)
        newest = F.max_by(F.struct("length", "changed", "generation"), "stamp").alias("m")
        return rows.groupBy("path").agg(newest).select("path", "m.*")

    def files(self, source: str | Sequence[str]) -> DataFrame:
        """(path, length, changed) of the files below ``source``, no content."""
        binary = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        found = binary.load([source] if isinstance(source, str) else list(source))
        return found.select("path", "length", F.unix_micros("modificationTime").alias("changed"))

    def update(self, source: str | Sequence[str]) -> list[str]:
        """Read what is new or changed; returns those files' paths."""
        new = self.files(source).join(self.manifest(), ["path", "length", "changed"], "left_anti").collect()
        if new:
            generation = "g" + uuid.uuid4().hex
            rows = self.read(self.spark, [r["path"] for r in new])
            kept = rows.groupBy(plain_path(F.input_file_name(), True).alias("file"), *self.keys).agg(*self.partials)
            kept.write.parquet(f"{self.folder}/partials/generation={generation}")
            now = F.unix_micros(F.current_timestamp())
            done = self.spark.createDataFrame([(r["path"], r["length"], r["changed"], generation) for r in new], _MANIFEST)
            done.withColumn("stamp", now).write.mode("append").parquet(f"{self.folder}/manifest")
        return sorted(r["path"] for r in new)

    def current(self, source: str | Sequence[str]) -> DataFrame | None:
        """The partial results of the files that are below ``source`` now; None
        before the first update that found a file."""
        if not self._exists(f"{self.folder}/partials"):
            return None
        there = self.files(source).join(self.manifest(), ["path", "length", "changed"])
        there = there.select(plain_path(F.col("path"), False).alias("file"), "generation")
        partials = self.spark.read.parquet(f"{self.folder}/partials")
        return partials.join(there, ["file", "generation"]).drop("file", "generation")


def plain_path(path: Column, encoded: bool) -> Column:
    """A file's path in one spelling: one slash behind the scheme, and no
    percent signs, which Spark's name of a row's file has for odd characters."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")
