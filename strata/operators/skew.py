"""Joins on keys of which a few hold much of the rows, and how evenly tasks are filled.

Heavy hitters are the keys above a share of the rows: at most 1 / share of them, whatever the size.
Their fact rows are dealt over ``salts``, their dimension rows are repeated once per salt, and all
other keys join as they are (salt 0), in one shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARE, SALTS = 0.01, 32


def heavy_hitters(df: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """(key, nb): keys that hold more than ``share`` of the rows with a key; fewer than 1 / share rows.
    Counts are partial before the shuffle, so a hot key costs one row per task."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("nb"))
    total = counts.agg(F.sum("nb").alias("_total"))
    return counts.join(F.broadcast(total), F.col("nb") > share * F.col("_total")).drop("_total")   # one row


def skew_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", share: float = SHARE, salts: int = SALTS) -> DataFrame:
    """``fact`` joined with ``dim`` on ``key`` (inner or left; one key column out), heavy keys salted.

    A fact row's salt comes from a hash of its columns, so a retried task deals it the same way; rows that
    are equal in every column share a salt. The list of heavy keys is at most 1 / share rows, which
    bounds its broadcast. Dimension rows of heavy keys are repeated ``salts`` times."""
    if how not in ("inner", "left"):
        raise ValueError("skew_join is inner or left")
    hot = F.broadcast(heavy_hitters(fact, key, share).select(F.col(key).alias("_hot")))
    left = fact.join(hot, fact[key] == F.col("_hot"), "left")
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(F.col("_hot").isNotNull(), spread).otherwise(F.lit(0))).drop("_hot")
    right = dim.join(hot, dim[key] == F.col("_hot"), "left")
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(every)).drop("_hot")
    # a shuffled join by design: the dimension may be of any size
    return left.join(right.hint("merge"), [key, "_salt"], how).drop("_salt")


def task_balance(spark: SparkSession, log: str) -> DataFrame:
    """Per stage of a Spark event log: tasks, rows and bytes read by shuffle, greatest and median rows and
    milliseconds of a task. The log is read as a table of JSON lines; ended tasks that succeeded count."""
    schema = ("Event string, `Stage ID` int, `Task End Reason` struct<Reason: string>, `Task Info` struct<`Launch Time`: long, `Finish Time`: long>, "
              "`Task Metrics` struct<`Shuffle Read Metrics`: struct<`Total Records Read`: long, `Remote Bytes Read`: long, `Local Bytes Read`: long>, "
              "`Input Metrics`: struct<`Records Read`: long, `Bytes Read`: long>>")
    ends = spark.read.schema(schema).json(log).where("Event = 'SparkListenerTaskEnd' AND `Task End Reason`.Reason = 'Success'")
    shuffle, scan = F.col("Task Metrics.Shuffle Read Metrics"), F.col("Task Metrics.Input Metrics")
    tasks = ends.select(F.col("Stage ID").alias("stage"), shuffle["Total Records Read"].alias("rows"),
                        (shuffle["Remote Bytes Read"] + shuffle["Local Bytes Read"]).alias("bytes"),
                        scan["Records Read"].alias("scanned_rows"), scan["Bytes Read"].alias("scanned_bytes"),
                        (F.col("Task Info.Finish Time") - F.col("Task Info.Launch Time")).alias("ms"))
    return tasks.groupBy("stage").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
        F.sum("scanned_rows").alias("scanned_rows"), F.sum("scanned_bytes").alias("scanned_bytes"),
        F.max("rows").alias("max_rows"), F.expr("percentile(rows, 0.5)").alias("median_rows"),
        F.max("ms").alias("max_ms"), F.expr("percentile(ms, 0.5)").alias("median_ms"))
