"""Skew: one key holding a third of all rows (a synthetic frame, test only)."""

import os
import re

from pyspark.sql import functions as F

from strata.plans.explain import plan_text

from strata.operators import aggregate as agg
from strata.operators import clean as cl
from strata.operators import measure
from strata.operators.ranking import rank_within_group
from strata.session import scratch_path
from strata.sources import sinks


def skewed(spark, n=300_000):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    return spark.range(n).select(
        F.col("id").alias("num_acc"),
        F.when(F.col("id") % 3 == 0, F.lit("00")).otherwise(F.lpad((F.col("id") % 1000).cast("string"), 3, "0"))
         .alias("dep"),
        (F.col("id") % 5).cast("int").alias("meteo"))


def plan(df):
    return plan_text(df)


def test_salted_equals_plain_and_shuffles_on_salt(spark):
    df = skewed(spark)
    salted = measure.salted_aggregate(df, "dep", "num_acc", 16)
    p = plan(salted)
    assert re.search(r"hashpartitioning\(dep#\d+, _salt#\d+L?, ", p), p
    plain = df.groupBy("dep").agg(F.count(F.lit(1)).cast("bigint").alias("nb_lignes"),
                                  F.count_distinct("num_acc").alias("nb_accidents"))
    assert sorted(plain.collect()) == sorted(salted.select(*plain.columns).collect())


def test_hot_group_sends_partial_rows_only(spark):
    """count by a hot key: each map task ships one partial row per key."""
    p = plan(agg.count_by_category(skewed(spark), "dep", "nb"))
    assert "partial_count" in p


def test_keyed_dedup_and_group_rank_limit_before_shuffle(spark):
    df = skewed(spark)
    d = cl.dedup_by_key(df, "dep", [F.asc("num_acc")])
    r = rank_within_group(df, ["dep"], [F.asc("num_acc")], 2)
    for q in (d, r):
        p = plan(q)
        assert "WindowGroupLimit" in p and "Partial" in p
    assert d.count() == 1001
    assert r.where("dep = '00'").count() == 2


def test_rebalanced_write_splits_hot_partition_value(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = scratch_path(spark, "skew-write")
        sinks.write_partitioned(skewed(spark, 600_000), path, ["dep"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    local = path.replace("file:", "", 1)
    hot = [f for f in os.listdir(f"{local}/dep=00") if f.endswith(".parquet")]
    cold = [f for f in os.listdir(f"{local}/dep=001") if f.endswith(".parquet")]
    # the hot value (a third of the rows) is written by several tasks
    assert len(hot) > 2 and len(hot) > len(cold), (len(hot), len(cold))
    assert spark.read.parquet(path).count() == 600_000


def test_aqe_splits_a_hot_join_key(spark):
    """A join key holding a third of the rows: AQE splits its partition
    (skew join) instead of giving it to one task."""
    from strata.plans.explain import plan_text
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        facts = skewed(spark, 600_000).select("dep", "num_acc")
        dims = spark.range(1001).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("dep"),
                                        (F.col("id") % 7).alias("region"))
        dims = dims.withColumn("dep", F.when(F.col("dep") == "000", F.lit("00")).otherwise(F.col("dep")))
        joined = facts.join(dims, "dep").groupBy("region").agg(F.count(F.lit(1)).alias("n"))
        rows = joined.collect()
        final = plan_text(joined)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["n"] for r in rows) == 600_000
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final, final
