"""Loading that sets rejected values aside, with the reason, in the same pass.

A text that a canonical column's conversion turns into NULL is a rejection. The
files are read once: every row is written with its typed columns and the list of
its rejections, and the counts are observed by the writing job itself. Rows
without rejections and those with some are then read from that table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from precinct.functions._cols import unused
from precinct.session import scratch_path
from precinct.sources.csv import (
    INCIDENT_HEADERS,
    INCIDENT_SCHEMA,
    _norm,
    header_groups,
    read_csv_raw,
)

Schema = Mapping[str, tuple[str, Callable[[Column], Column]]]
REJECTION = "array<struct<column:string,text:string,reason:string>>"


@dataclass
class Loaded:
    """``rows``: all rows, typed, rejected values as NULL. ``clean``: those
    without a rejection. ``rejections``: (key, column, text, reason) of each
    rejected value. ``counts``: rows, rows with a rejection and, for each column,
    its rejections, as observed while the table was written."""

    rows: DataFrame
    clean: DataFrame
    rejections: DataFrame
    counts: dict[str, int]


def load_with_quarantine(
    spark: SparkSession,
    paths: str | Sequence[str],
    headers: Mapping[str, str] = INCIDENT_HEADERS,
    schema: Schema = INCIDENT_SCHEMA,
    key: str = "incident_id",
) -> Loaded:
    """Files of any mix of headers, with their rejected values aside."""
    name = unused("rejections", list(schema))
    table = None
    for files in header_groups(spark, paths):
        part = _split(read_csv_raw(spark, files), headers, schema, name)
        table = part if table is None else table.unionByName(part)
    if table is None:
        table = _split(spark.createDataFrame([], "_none string"), headers, schema, name)
    seen = Observation()
    columns = F.transform(name, lambda f: f["column"])
    of = [F.count_if(F.array_contains(columns, c)).alias(c) for c in schema]
    observed = table.observe(seen, F.count(F.lit(1)).alias("_rows"), F.count_if(F.size(name) > 0).alias("_rejected"), *of)
    path = scratch_path(spark, "quarantine")
    observed.write.parquet(path)
    both = spark.read.schema(table.schema).parquet(path)
    found = seen.get
    counts = {"rows": found["_rows"], "rejected_rows": found["_rejected"]} | {c: found[c] for c in schema}
    rejections = both.select(F.col(key), F.explode(name).alias("f")).select(key, "f.column", "f.text", "f.reason")
    return Loaded(both.drop(name), both.where(F.size(name) == 0).drop(name), rejections, counts)


def _split(raw: DataFrame, headers: Mapping[str, str], schema: Schema, name: str) -> DataFrame:
    """:func:`canonicalise` and the list of rejections, side by side."""
    by_norm = {_norm(h): canon for h, canon in headers.items()}
    present: dict[str, str] = {}
    for c in raw.columns:
        canon = by_norm.get(_norm(c))
        if canon is not None:
            present.setdefault(canon, c)
    columns, faults = [], []
    for canon, (kind, convert) in schema.items():
        if canon not in present:
            columns.append(F.lit(None).cast(kind).alias(canon))
            continue
        text = F.col(f"`{present[canon]}`").cast("string")
        value = convert(text).cast(kind)
        columns.append(value.alias(canon))
        told = F.struct(F.lit(canon).alias("column"), text.alias("text"), F.lit(f"not a {kind}").alias("reason"))
        faults.append(F.when((F.trim(text) != "") & value.isNull(), told))
    listed = F.array_compact(F.array(*faults)) if faults else F.array()
    return raw.select(*columns, listed.cast(REJECTION).alias(name))
