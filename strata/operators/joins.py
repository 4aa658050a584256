"""Keyed joins that are safe against fan-out, and size-guarded broadcasts.

Rules of this module:

* an n-side table is reduced to one row per key (``distinct`` keys or a
  per-key aggregate, both partially aggregated before the shuffle) before it
  meets another table, so measures are never multiplied by fan-out;
* a broadcast hint is only given behind a proven bound in bytes; beyond it a
  warning is given and the join is left to Catalyst / AQE (sort-merge, or a
  runtime broadcast when the shuffled side turns out small);
  ``join_strategies`` tells what a plan chose.
"""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side we hint for broadcast (bytes in memory).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
TEXT_BYTES = 40  # assumed for a text value; a row header and alignment are added per row


def row_bytes(df: DataFrame) -> int:
    """Bytes a row of ``df`` takes in memory, by its declared types."""
    widths = {"string": TEXT_BYTES, "binary": TEXT_BYTES}
    return 16 + sum(widths.get(f.dataType.typeName(), 16) for f in df.schema.fields)


def source_bytes(spark: SparkSession, path: str) -> int:
    """Bytes on disk of the Parquet files under ``path`` (a listing only)."""
    from strata.sources.files import file_bytes
    return file_bytes(spark, path, "*.parquet")


def source_row_bound(spark: SparkSession, path: str) -> int:
    """Row count of a Parquet source, a bound for anything derived from it by filters,
    projections or distinct. Only the file footers are read, at any size."""
    return spark.read.parquet(path).count()


def broadcast_if_bounded(df: DataFrame, upper_bound_rows: int | None,
                         max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only when its size is proven: at most
    ``upper_bound_rows`` rows of its width within ``max_bytes``. Otherwise a warning
    says that the hint is left out and Catalyst chooses (rows are the same)."""
    if upper_bound_rows is not None and upper_bound_rows * row_bytes(df) <= max_bytes:
        return F.broadcast(df)
    size = "no bound" if upper_bound_rows is None else f"up to {upper_bound_rows * row_bytes(df)} bytes"
    warnings.warn(f"broadcast not hinted: {size}, the limit is {max_bytes}", stacklevel=3)
    return df


def join_strategies(df: DataFrame) -> list[str]:
    """The join operators of the physical plan, top down."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"\b(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\b", text)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """One row per key of an n-side table (partial aggregation map-side)."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def keyed_inner_join(left: DataFrame, right: DataFrame, key: str,
                     strategy: str = "auto", right_bound_rows: int | None = None) -> DataFrame:
    """Inner equi-join on one key column (USING semantics, one key column out).

    strategy: ``auto`` leaves the choice to Catalyst/AQE; ``shuffle`` forces a
    sort-merge join; ``broadcast`` hints the right side when its bound is known
    and small, else (no bound, or too many rows) falls back to ``auto``.
    """
    if strategy == "shuffle":
        right = right.hint("shuffle_merge")
    elif strategy == "broadcast":
        right = broadcast_if_bounded(right, right_bound_rows)
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return left.join(right, on=key, how="inner")


def dimension_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   dim_rows: int | None, how: str = "inner") -> DataFrame:
    """Fact to small-dimension lookup; the dimension is broadcast when its
    counted size allows it."""
    d = broadcast_if_bounded(dim, dim_rows)
    return fact.join(d, fact[fact_key] == d[dim_key], how)


def four_table_join(accidents: DataFrame, places: DataFrame, vehicles: DataFrame,
                    severity: DataFrame, key: str = "num_acc") -> DataFrame:
    """One row per accident with per-key summaries of the three n-side tables.

    Each n-side table is first reduced to one row per key, so the left joins
    never fan out; accidents without places/vehicles/persons keep NULL/0.
    """
    p = places.groupBy(key).agg(F.count(F.lit(1)).alias("nb_lieux"))
    v = vehicles.groupBy(key).agg(F.count(F.lit(1)).alias("nb_vehicules"),
                                  F.count_distinct("cat_veh").alias("nb_categories"))
    s = severity.select(key, "gravite_max", "nb_usagers", "accident_grave")
    return (accidents.join(p, key, "left").join(v, key, "left").join(s, key, "left")
            .withColumns({
                "nb_lieux": F.coalesce("nb_lieux", F.lit(0).cast("bigint")),
                "nb_vehicules": F.coalesce("nb_vehicules", F.lit(0).cast("bigint")),
                "nb_categories": F.coalesce("nb_categories", F.lit(0).cast("bigint")),
                "nb_usagers": F.coalesce("nb_usagers", F.lit(0).cast("bigint")),
            }))
