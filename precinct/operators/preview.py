"""A look at a table: rows that are the same at each evaluation.

``show`` and ``limit`` give whatever rows come first, so two looks differ. A
preview takes the rows with the smallest digests of their key: each task keeps
the best few of its rows in a heap, and the heaps are merged, so nothing is
sorted whole and the cost beyond the scan does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.functions._cols import unused

#: Rows of a look, as many as ``show`` prints.
ROWS = 20


def preview(df: DataFrame, key: Sequence[str] | None = None, rows: int = ROWS) -> DataFrame:
    """At most ``rows`` rows of ``df``, by the MD5 digest of ``key`` (all columns
    if none is given), then by the key itself. Rows with equal keys are all as
    good; a null key is a key."""
    key = list(key) if key else df.columns
    if len(key) == 1:
        text = F.coalesce(F.col(f"`{key[0]}`").cast("string"), F.lit("null"))
    else:
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in key]), {"ignoreNullFields": "false"})
    digest, told = unused("digest", df.columns), unused("told", df.columns)
    marked = df.withColumn(told, text).withColumn(digest, F.md5(F.col(told)))
    return marked.orderBy(digest, told).limit(rows).select(*[f"`{c}`" for c in df.columns])
