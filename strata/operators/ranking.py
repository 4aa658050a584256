"""Top-k and ranking with deterministic tie-breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows by ``order`` (TakeOrderedAndProject: per-partition top-k,
    then one merge of k rows per partition). ``order`` must end in a unique
    tie-break."""
    return df.orderBy(*order).limit(k)


def rank_global(df: DataFrame, order: list[Column], k: int, rank_col: str = "rang") -> DataFrame:
    """row_number over the whole frame, kept <= k.

    The limit is applied first (top_k), so the unpartitioned window only ever
    sees k rows whatever the input size.
    """
    w = Window.orderBy(*order)
    return top_k(df, order, k).withColumn(rank_col, F.row_number().over(w))


def rank_within_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                      rank_col: str = "rang") -> DataFrame:
    """row_number per group, kept <= k. Spark plans a partial WindowGroupLimit
    before the shuffle, so a hot group sends at most k rows per map task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
