"""Gold that follows deliveries: counts, sums and maxima per group without a second look at all of silver.

Silver is partitioned by a bucket of its key; gold is a log of signed counts per (group, score), one folder a
delivery. A delivery reads the buckets that it touches only: the rows it replaces are subtracted, its
own are added. A sum of counts can be taken back, and a maximum is the greatest score that
still has rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expressions import safe_ratio
from strata.session import scratch_path
from strata.sources.files import missing_paths

KEY, GROUP, SCORE, FLAG, BUCKET = "num_acc", "dep", "score", "grave", "key_bucket"
SILVER = f"{KEY} long, {GROUP} string, {SCORE} int, {FLAG} int"
GOLD = f"{GROUP} string, {SCORE} int, nb long, graves long"


def silver(spark: SparkSession, base: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows stored so far (of some buckets: by partition pruning); none before the first delivery."""
    path = f"{base}/silver"
    if missing_paths(spark, [path]):
        return spark.createDataFrame([], f"{SILVER}, {BUCKET} int")
    rows = spark.read.schema(f"{SILVER}, {BUCKET} int").parquet(path)
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))


def deliver(spark: SparkSession, base: str, number: int, rows: DataFrame, bucket: Column) -> list[int]:
    """Merge delivery ``number``: one row per key, which replaces the key's stored row. Returns the buckets touched.

    The signed counts are written first and once; then the touched buckets are overwritten. A delivery that
    broke in between is run again as it was: its counts stay, and the merge gives the same rows."""
    fresh = rows.select(*[c.split(" ")[0] for c in SILVER.split(", ")]).where(F.col(KEY).isNotNull()).withColumn(BUCKET, bucket.cast("int"))
    staging = scratch_path(spark, "delivery")
    fresh.write.parquet(f"{staging}/fresh")
    fresh = spark.read.schema(fresh.schema).parquet(f"{staging}/fresh")
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())   # bounded by the number of buckets
    stored = silver(spark, base, touched)
    log = f"{base}/gold/delivery={number}"
    if missing_paths(spark, [log]):
        old = stored.join(fresh.select(KEY), KEY, "left_semi")
        signed = fresh.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
        delta = signed.groupBy(GROUP, SCORE).agg(F.sum("_sign").alias("nb"), F.sum(F.col("_sign") * F.coalesce(FLAG, F.lit(0))).alias("graves"))
        delta.coalesce(1).write.mode("overwrite").parquet(log)   # groups x scores
    merged = stored.join(fresh.select(KEY), KEY, "left_anti").unionByName(fresh)
    merged.write.parquet(f"{staging}/merged")
    merged = spark.read.schema(merged.schema).parquet(f"{staging}/merged")
    (merged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(f"{base}/silver"))
    return touched


def gold(spark: SparkSession, base: str) -> DataFrame:
    """Per group: accidents, serious ones, greatest and mean score, from the log alone. A group that lost
    its last accident is absent; accidents without a score count, but not in the mean."""
    log = spark.read.schema(f"{GOLD}, delivery int").parquet(f"{base}/gold")
    state = log.groupBy(GROUP, SCORE).agg(F.sum("nb").alias("nb"), F.sum("graves").alias("graves")).where("nb > 0")
    scored = F.when(F.col(SCORE).isNotNull(), F.col("nb"))
    return state.groupBy(GROUP).agg(
        F.sum("nb").alias("nb_accidents"), F.sum("graves").alias("nb_graves"), F.max(SCORE).alias("score_max"),
        F.round(safe_ratio(F.sum(F.col(SCORE) * F.col("nb")), F.sum(scored)), 6).alias("score_moyen"))
