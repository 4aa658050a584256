"""Partitions switched in one step, clustered layout, stream-static join, the UDF ways."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strata.operators import skew
from strata.plans import experiments
from strata.session import scratch_path
from strata.sources import versions
from strata.streaming import enrich
from tests.conftest import SF001
from tests.test_stateful import arrivals


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "versions")
    name = "t_" + path.rsplit("-", 1)[1]
    df = spark.createDataFrame([(k, dep) for k, dep in enumerate(["07", "2A", None, "it's", "a/b", "%20"] * 5)], "id long, dep string")
    versions.create(spark, name, path, df, "dep")
    versions.replace_partitions(spark, name, path, df, "dep")
    yield name, path, df
    spark.sql(f"DROP TABLE {name}")


def rows(spark, name):
    return sorted(((r.id, r.dep) for r in spark.table(name).collect()), key=str)


def test_partitions_are_replaced(spark, table):
    name, path, df = table
    assert rows(spark, name) == sorted(((r.id, r.dep) for r in df.collect()), key=str)
    new = spark.createDataFrame([(100, "07"), (101, "it's"), (102, "new")], "id long, dep string")
    assert versions.replace_partitions(spark, name, path, new, "dep") == ["07", "it's", "new"]
    kept = [(r.id, r.dep) for r in df.collect() if r.dep not in ("07", "it's")]
    assert rows(spark, name) == sorted([*kept, (100, "07"), (101, "it's"), (102, "new")], key=str)
    versions.drop_partitions(spark, name, "dep", ["07", "2A"])
    assert {d for _, d in rows(spark, name)} == {None, "it's", "a/b", "%20", "new"}


def test_a_run_that_breaks_leaves_the_old_rows(spark, table, monkeypatch):
    name, path, df = table
    before = rows(spark, name)
    new = spark.createDataFrame([(100, "07"), (101, "2A")], "id long, dep string")
    folder = versions.stage(new, path, "dep")   # and no switch
    assert rows(spark, name) == before
    with pytest.raises(Exception):
        versions.stage(new.withColumn("id", F.raise_error(F.lit("broken"))), path, "dep")
    assert rows(spark, name) == before
    versions.switch(spark, name, folder, "dep")
    assert {(100, "07"), (101, "2A")} <= set(rows(spark, name)) and len(rows(spark, name)) == len(before) - 8


RUN = """
import sys
from strata.session import get_session
log, layout, query = sys.argv[1:]
spark = get_session("log", master="local[4]", shuffle_partitions=8, extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log, "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.checkpoint.dir": log + "-ckpt"})
spark.read.parquet(layout).where(query).write.format("noop").mode("overwrite").save()
spark.stop()
"""


def read_by(spark, tmp_path, layout, query):
    """(rows, bytes) that the scan read, by Spark's event log."""
    log = tmp_path / f"log-{len(list(tmp_path.iterdir()))}"
    log.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", RUN, str(log), layout, query], check=True, cwd=root, env={**os.environ, "PYTHONPATH": root}, timeout=300,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    last = skew.task_balance(spark, str(log)).orderBy(F.desc("stage")).first()
    return last.scanned_rows, last.scanned_bytes


def test_filters_skip_row_groups(spark, tmp_path):
    df = spark.range(400_000).select(F.xxhash64("id").alias("key"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).alias("dep"),
                                     F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)).alias("an"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    flat, clustered = scratch_path(spark, "flat"), scratch_path(spark, "clustered")
    df.repartition(8).write.parquet(flat)
    versions.write_clustered(df, clustered, ["dep", "an"], bloom=["key"], files=8)
    one = df.where("id = 77").first() if "id" in df.columns else df.first()
    for query in ("dep = 7 and an = 3", f"key = {one.key}"):
        want = {tuple(r) for r in df.where(query).collect()}
        assert want and {tuple(r) for r in spark.read.parquet(clustered).where(query).collect()} == want
    by_range = read_by(spark, tmp_path, clustered, "dep = 7 and an = 3"), read_by(spark, tmp_path, flat, "dep = 7 and an = 3")
    assert by_range[0][0] < by_range[1][0] / 2 and by_range[0][1] < by_range[1][1] / 2
    by_bloom = read_by(spark, tmp_path, clustered, f"key = {one.key}"), read_by(spark, tmp_path, flat, f"key = {one.key}")
    assert by_bloom[0][0] < by_bloom[1][0] / 2


SCHEMA = "user_id long, name string"


def test_stream_joined_with_a_table_that_changes(spark):
    source, static, out, ckpt = (scratch_path(spark, x) for x in ("src", "static", "out", "ckpt"))
    users = spark.range(5).select(F.col("id").alias("user_id"), F.concat(F.lit("a"), "id").alias("name"))
    users.write.parquet(static)
    arrivals(spark, source, [0, 1])
    enrich.run_enriched(spark, source, static, SCHEMA, "user_id", out, ckpt, 1)
    first = spark.read.schema(enrich.EVENTS_SCHEMA).parquet(source)
    want = first.join(users, "user_id", "left").select("event_id", "name")
    got = enrich.read_enriched(spark, out, SCHEMA, "user_id").select("event_id", "name")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.where("name is null").count() > 0
    users.withColumn("name", F.lit("new")).write.mode("overwrite").parquet(static)
    arrivals(spark, source, [2])
    enrich.run_enriched(spark, source, static, SCHEMA, "user_id", out, ckpt, 1)
    rows = enrich.read_enriched(spark, out, SCHEMA, "user_id")
    assert rows.count() == 600 and {r.name for r in rows.where("batch_id = 2").select("name").distinct().collect()} == {"new", None}


def test_udf_ways_agree_and_are_timed(spark):
    out = experiments.udf_ways(spark, SF001, runs=1)
    assert out["equal_results"] and set(out["gains"]) == {"native", "udf", "pandas", "arrow"}
    assert all(out[w]["min"] <= out[w]["median"] <= out[w]["max"] for w in ("native", "udf", "udf_pickled", "pandas", "arrow"))


def test_headers_are_read_without_the_files(spark, tmp_path):
    """Files of two layouts: the probe reads their first lines, not their rows."""
    from strata.sources import files
    for n, header in enumerate(("a;b", "b;a")):
        (tmp_path / f"{n}.csv").write_text(header + "\n" + "1;2\n" * 400_000)
    sc = spark.sparkContext
    sc.setJobGroup("header-probe", "")
    try:
        assert sorted(files.header_layouts(spark, str(tmp_path), "utf-8")) == ["a;b", "b;a"]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    found = sc.statusTracker()
    store = sc._jsc.sc().statusStore()
    read = sum(store.lastStageAttempt(s).inputRecords() for j in found.getJobIdsForGroup("header-probe") for s in found.getJobInfo(j).stageIds)
    assert read < 400_000


def test_older_layout_tasks_do_not_grow_with_the_source(spark, monkeypatch):
    from strata.plans import older_layout
    from tests.conftest import SF001
    whole = [tuple(r) for r in older_layout.top_departments(older_layout.silver_from_driver(spark, SF001)).collect()]
    monkeypatch.setattr(older_layout, "TASK_BYTES", 4096)
    tables = older_layout.silver_from_driver(spark, SF001)
    assert older_layout._with_department(tables).rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert [tuple(r) for r in older_layout.top_departments(tables).collect()] == whole
