"""Timestamps of files that do not agree on their format.

Files of one folder may write 05/13/2020 or 13/05/2020. A single text cannot
tell; a file can: each known format gets a vote for every text of the file that
it parses. Votes are sums, partial in each task, so one pass counts all files,
and only a row per file reaches the choice. The format with the most votes parses
the file; of equal ones the first in the list. What it does not parse is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.functions._cols import as_col, unused
from precinct.functions.temporal import SOURCE_TS_FORMAT, parse_timestamp
from precinct.operators.joins import checked_broadcast

# Layouts of timestamps, the source files' own first.
FORMATS = (
    SOURCE_TS_FORMAT,
    "dd/MM/yyyy hh:mm:ss a",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd.MM.yyyy HH:mm:ss",
)


def _text(col: Column | str) -> Column:
    return F.trim(as_col(col).cast("string"))


def votes(rows: DataFrame, column: str, file: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """(file, n_values, votes): how many texts of a file each format parses.
    Empty texts have no vote."""
    text = _text(column)
    accepted = [F.count(parse_timestamp(text, f)).alias(f"v{k}") for k, f in enumerate(formats)]
    counted = rows.groupBy(F.col(file).alias("file")).agg(F.count_if(text != "").alias("n_values"), *accepted)
    return counted.select("file", "n_values", F.array(*[f"v{k}" for k in range(len(formats))]).alias("votes"))


def elected(votes: DataFrame) -> DataFrame:
    """(file, format number, rejects): the first format with the most votes."""
    most = F.array_max("votes")
    chosen = (F.array_position("votes", most) - 1).cast("int")
    return votes.select("file", chosen.alias("format"), (F.col("n_values") - most).alias("rejects"))


def parsed(rows: DataFrame, column: str, file: str, out: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """``rows`` with ``out``, the timestamp under the format that the row's file
    elected. A row per file is joined to the rows, broadcast behind the size
    check. ``rows`` is read twice: for the votes and for the result."""
    number, name = (unused(n, rows.columns, [out]) for n in ("format", "file_"))
    choice = elected(votes(rows, column, file, formats)).select(F.col("file").alias(name), F.col("format").alias(number))
    text, value = _text(column), F.lit(None).cast("timestamp")
    for k, f in enumerate(formats):
        value = F.when(F.col(number) == k, parse_timestamp(text, f)).otherwise(value)
    joined = rows.join(checked_broadcast(choice), F.col(file).eqNullSafe(F.col(name)), "left")
    return joined.withColumn(out, value).drop(number, name)
