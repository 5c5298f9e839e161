"""Column types of text tables, found in one distributed pass.

Types form a lattice by what they accept. For every column and type one sum
counts the texts that the type accepts; the sums are partial in each task and
merged like any aggregate, so a pass over any number of files is one job whose
result is a row per column, and nothing is sampled. A column has the first type
in order that rejects at most a given share of its texts; ``string`` accepts all.

Cases: empty texts and white space are no values, and every type has them as
NULL. A column without values is a ``string``. Ties cannot occur, as the types
are in order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.functions.temporal import SOURCE_TS_FORMAT, parse_timestamp
from precinct.sources.csv import header_groups, read_csv_raw

#: Types from narrow to wide, with what a text becomes; NULL is a rejection.
TYPES: dict[str, Callable[[Column], Column]] = {
    "int": lambda c: F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int")),
    "bigint": lambda c: F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint")),
    "double": lambda c: F.when(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), c.try_cast("double")),
    "date": lambda c: F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c.try_cast("date")),
    "timestamp": lambda c: parse_timestamp(c, SOURCE_TS_FORMAT),
    "boolean": lambda c: F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False),
    "string": lambda c: c,
}


def accepted(raw: DataFrame) -> DataFrame:
    """A row per column of a text table: ``column``, ``n_values`` and, for each
    type, how many values it accepts. One aggregation."""
    counts, entries = [], []
    for k, name in enumerate(raw.columns):
        text = F.trim(F.col(f"`{name}`").cast("string"))
        value = F.when(text != "", text)
        made = {"n_values": F.count(value)} | {t: F.count(make(value)) for t, make in TYPES.items()}
        counts.append(F.struct(*[c.alias(n) for n, c in made.items()]).alias(f"c{k}"))
        entries.append(F.struct(F.lit(name).alias("column"), *[F.col(f"c{k}")[n].alias(n) for n in made]))
    if not counts:
        return raw.sparkSession.createDataFrame([], "column string, n_values bigint, " + ", ".join(f"{t} bigint" for t in TYPES))
    return raw.agg(*counts).select(F.inline(F.array(*entries)))


def merged(counts: DataFrame) -> DataFrame:
    """Counts of several tables, those of columns with one name together."""
    return counts.groupBy("column").agg(*[F.sum(c).alias(c) for c in ("n_values", *TYPES)])


def chosen(counts: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(column, type, n_values, rejects): the first type that rejects at most
    the share ``tolerance`` of the values."""
    rejects = {t: F.col("n_values") - F.col(t) for t in TYPES}
    first = F.lit("string")
    for t in reversed(TYPES):
        fits = (rejects[t] <= F.col("n_values") * tolerance) & (F.col("n_values") > 0)
        first = F.when(fits, F.lit(t)).otherwise(first)
    lost = F.coalesce(*[F.when(F.col("type") == t, rejects[t]) for t in TYPES])
    return counts.withColumn("type", first).select("column", "type", "n_values", lost.alias("rejects"))


def infer_types(raw: DataFrame, tolerance: float = 0.0) -> DataFrame:
    return chosen(accepted(raw), tolerance)


def text_tables(spark: SparkSession, paths: str | Sequence[str]) -> list[DataFrame]:
    """The files below ``paths`` as text, a table for each header, with headers
    trimmed; of a header that a file repeats the first column counts."""
    tables = []
    for files in header_groups(spark, paths):
        raw, names = read_csv_raw(spark, files), {}
        for c in raw.columns:
            names.setdefault(c.strip(), c)
        tables.append(raw.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()]))
    return tables


def infer_csv(spark: SparkSession, paths: str | Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Types over all files below ``paths``, whatever headers each has."""
    counts = [accepted(t) for t in text_tables(spark, paths)]
    if not counts:
        return chosen(accepted(spark.createDataFrame([], "c string").drop("c")), tolerance)
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return chosen(merged(every), tolerance)


def typed(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """A text table under the types given; what a type rejects is NULL."""
    texts = {c: F.trim(F.col(f"`{c}`").cast("string")) for c in raw.columns}
    return raw.select(
        *[
            (TYPES[t](F.when(texts[c] != "", texts[c])) if (t := types.get(c, "string")) != "string" else F.col(f"`{c}`")).alias(c)
            for c in raw.columns
        ]
    )


def read_csv_inferred(spark: SparkSession, paths: str | Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """The files below ``paths`` as one table, by name, under inferred types.
    The types (a row per column) are collected; the data are read twice, as text
    for the types and under them."""
    types = {r["column"]: r["type"] for r in infer_csv(spark, paths, tolerance).collect()}
    out = None
    for table in text_tables(spark, paths):
        missing = [F.lit(None).cast("string").alias(c) for c in types if c not in table.columns]
        part = typed(table.select("*", *missing).select(*[f"`{c}`" for c in types]), types)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "none string").drop("none")
