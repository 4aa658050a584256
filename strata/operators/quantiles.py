"""Exact quantiles of groups by repeated bucket counts.

A sort per group would put a group into one task. Here each pass counts the rows of every group in
``BUCKETS`` equal ranges between its bounds (partial aggregation: a task ships at most one row per
group and bucket), finds the bucket that holds the wanted rank and keeps its least and greatest
value as the next bounds, until they meet. All groups and fractions go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_if_bounded
from strata.session import scratch_path

BUCKETS = 1024


def _table(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_quantiles(df: DataFrame, group: str, value: str, fractions: dict[str, float], buckets: int = BUCKETS) -> DataFrame:
    """(group, nb, one column per fraction): the discrete quantiles of the values that are neither null nor
    NaN: of n, that of rank ``ceil(fraction * n)`` (1 at least). A group without any is absent; a null
    group is one like others.

    The rows (group, value) are written once to the scratch folder and read once a pass; a pass divides the
    range by ``buckets``, so few are needed. The state is one row per group and fraction, broadcast
    while that is within the limit for broadcasts."""
    spark = df.sparkSession
    v = F.col(value).cast("double")
    rows = _table(df.select(F.col(group).alias("g"), v.alias("v")).where(v.isNotNull() & ~F.isnan(v)), "quantile-rows")
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in fractions.items()]))
    state = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = state.select("g", "n", "lo", "hi", each.alias("f")).select(
        "g", "n", "lo", "hi", F.col("f.name").alias("name"), F.greatest(F.lit(1), F.ceil(F.col("f.q") * F.col("n"))).cast("long").alias("rank"))
    state = _table(state, "quantile-state")
    while True:
        open_ = state.where("lo < hi")
        count = open_.count()   # groups x fractions, not rows
        if not count:
            break
        side = broadcast_if_bounded(open_.withColumnsRenamed({"g": "_g", "n": "_n"}), count)
        met = rows.join(side, F.col("g").eqNullSafe(F.col("_g")) & F.col("v").between(F.col("lo"), F.col("hi")))
        # halves first, so that the width of any two doubles is finite
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        at = F.least(F.floor(share * buckets), F.lit(buckets - 1))
        counted = met.groupBy("_g", "_n", "name", "rank", at.alias("at")).agg(
            F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("c").over(Window.partitionBy("_g", "name").orderBy("at"))   # at most ``buckets`` rows
        held = counted.withColumn("upto", upto).where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
        held = held.select(F.col("_g").alias("g"), F.col("_n").alias("n"), "lo", "hi", "name",
                           (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"))
        # the rank within the bucket's own bounds: values below them count no longer
        state = _table(held.union(state.where("lo = hi").select(held.columns)), "quantile-state")
    return (state.groupBy(F.col("g").alias(group)).agg(
        F.max("n").alias("nb"), *[F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in fractions]))
