"""Ranking: top-k per group (window + filter) and global top / bottom k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def rank_within(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], fn: str = "rank", out: str = "rank"
) -> DataFrame:
    """Add ``out`` = ``fn()`` over (partition by ..., order by ...)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(out, _RANKERS[fn]().over(w))


def top_k_per_group(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    k: int,
    fn: str = "rank",
    out: str = "rank",
) -> DataFrame:
    """Rows ranked ``<= k`` inside each group (``rank`` keeps ties).

    The rank-then-filter shape lets Catalyst insert ``WindowGroupLimit``
    before the shuffle, so at most k rows (plus ties) per group and map
    partition cross the network even when one group is huge.
    """
    return rank_within(df, partition_by, order_by, fn, out).where(F.col(out) <= k)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """Global top k by ``order_by`` (``TakeOrderedAndProject``: per-partition
    top k, then one merge of ``k x partitions`` rows)."""
    return df.orderBy(*order_by).limit(k)


def extremes(df: DataFrame, value_col: str, key_col: str, k: int) -> DataFrame:
    """Distinct ``key_col`` of the k highest and k lowest ``value_col`` rows.

    Ties on the value are broken by the key, so the choice is deterministic.
    Rows with a NULL value rank in neither list. At most ``2k`` rows.
    """
    known = df.where(F.col(value_col).isNotNull())
    top = top_k(known, [F.desc(value_col), F.asc(key_col)], k).select(key_col)
    bottom = top_k(known, [F.asc(value_col), F.asc(key_col)], k).select(key_col)
    return top.union(bottom).distinct()
