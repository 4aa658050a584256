"""Invariants: A/B arms equal, stream = batch, upsert idempotent, report sums."""

from pyspark.sql import functions as F

from strata.operators import measure
from strata.plans import bindings, layers
from strata.plans.catalog import QUERIES
from strata.session import scratch_path
from strata.sources import sinks
from tests.conftest import SF001

Q = QUERIES


def test_ab_harness_equal_arms(spark):
    res = measure.time_arms(
        spark,
        {"shuffle": lambda: Q["join_departments_shuffle"](spark, SF001),
         "broadcast": lambda: Q["join_departments_broadcast"](spark, SF001)},
        runs=1, confs={"shuffle": {"spark.sql.autoBroadcastJoinThreshold": "-1"}})
    assert res["equal_results"] is True
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_cache_scope_releases(spark):
    df = layers.silver_from_driver(spark, SF001)["accidents"]
    with measure.cached(df) as c:
        assert c.is_cached
    assert not df.is_cached


def test_clean_report_adds_up(spark):
    for r in layers.driver_report(spark, SF001).collect():
        assert r["raw_rows"] == (r["duplicate_rows"] + r["rejected_key"] + r["rejected_required"] + r["rejected_range"]
                                 + r["rejected_outlier"] + r["rejected_repeated_key"] + r["kept_rows"])


def test_stream_equals_batch(spark):
    from strata.streaming import windowed
    stream = Q["stream_windowed_counts"](spark, SF001)
    ev = spark.read.schema(windowed.EVENTS_SCHEMA).parquet(f"{SF001}/events.parquet")
    batch = windowed.finish(windowed.windowed_counts(ev, "1 hour"), "UTC")
    assert sorted(stream.collect()) == sorted(batch.select(*stream.columns).collect())


def test_upsert_is_idempotent(spark):
    acc = layers.silver_from_driver(spark, SF001)["accidents"]
    first = acc.where(F.col("an") <= 1998).withColumn("version", F.lit(1))
    second = acc.where(F.col("an") >= 1998).withColumn("version", F.lit(2))
    path = scratch_path(spark, "upsert-test")
    sinks.write_partitioned(first, path, ["an"])
    sinks.upsert_partitions(spark, path, second, ["num_acc"], "an")
    once = sorted(spark.read.parquet(path).collect())
    sinks.upsert_partitions(spark, path, second, ["num_acc"], "an")
    twice = sorted(spark.read.parquet(path).collect())
    assert once == twice
    assert len(once) == acc.count()


def test_write_all_reports_failures(spark):
    import pytest
    bad = spark.range(3).withColumn("x", F.lit(1))
    with pytest.raises(RuntimeError, match="failed"):
        sinks.write_all({"t": bad}, scratch_path(spark, "wa"), partitions={"t": ["missing_col"]})


def test_checkpoint_root_is_read_from_session(spark):
    from strata.session import checkpoint_root
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_stream_over_many_micro_batches_equals_batch(spark):
    """Events dealt over files by hash, read two files per trigger, so every window
    comes in several micro-batches and in any order: their sum is the batch result."""
    from strata.streaming import windowed
    ev = spark.read.schema(windowed.EVENTS_SCHEMA).parquet(f"{SF001}/events.parquet")
    src = scratch_path(spark, "events-by-hash")
    ev.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(8))).repartition("part").write.partitionBy("part").parquet(src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    windowed.run_windowed_counts(spark, f"{src}/part=*/*.parquet", out, ckpt, max_files_per_trigger=2)
    n_batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert n_batches > 3
    stream = windowed.read_windowed_counts(spark, out)
    batch = windowed.finish(windowed.windowed_counts(ev, "1 hour"), "UTC")
    assert sorted(stream.collect()) == sorted(batch.select(*stream.columns).collect())


def test_stream_windows_do_not_depend_on_session_zone(spark):
    """Half-hour-offset session zone: windows still start on the hour."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        rows = Q["stream_windowed_counts"](spark, SF001).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert rows and all(r["window_start"].minute == 0 and r["window_start"].second == 0 for r in rows)
    assert min(r["window_start"] for r in rows).isoformat() == "2024-01-01T00:00:00"


def test_upsert_keeps_latest_version_within_a_delivery(spark):
    base = spark.createDataFrame([(1, 2000, "a", 1), (2, 2000, "b", 1), (3, 2001, "c", 1)],
                                 "num_acc long, an int, v string, version int")
    path = scratch_path(spark, "upsert-versions")
    sinks.write_partitioned(base, path, ["an"])
    upd = spark.createDataFrame([(2, 2000, "b2", 2), (2, 2000, "b3", 3), (4, 2000, "d", 2)],
                                "num_acc long, an int, v string, version int")
    sinks.upsert_partitions(spark, path, upd, ["num_acc"], "an", version="version")
    got = sorted((r["num_acc"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a"), (2, "b3"), (3, "c"), (4, "d")]


def test_upsert_older_delivery_moved_key_and_text_partition(spark):
    schema = "num_acc long, dep string, v string, version int"
    path = scratch_path(spark, "upsert-three")
    sinks.write_partitioned(spark.createDataFrame([(1, "07", "a", 5), (2, "2A", "b", 1), (3, "10", "c", 1)], schema), path, ["dep"])
    updates = spark.createDataFrame([(1, "07", "old", 3), (2, "07", "moved", 2), (4, None, "d", 1)], schema)
    for _ in range(2):   # the same delivery again changes nothing
        sinks.upsert_partitions(spark, path, updates, ["num_acc"], "dep", version="version")
        got = sorted(map(tuple, spark.read.schema(schema).parquet(path).select("num_acc", "dep", "v", "version").collect()))
        assert got == [(1, "07", "a", 5), (2, "07", "moved", 2), (3, "10", "c", 1), (4, None, "d", 1)]


def test_lazy_tables_are_a_mapping(spark):
    t = layers.silver_from_driver(spark, SF001)
    assert len(t) == 5 and t.get("nothing") is None and t.get("places") is t["places"] and len(list(t.values())) == 5


def test_whole_rows_are_kept_apart(spark):
    s = layers.silver_from_driver(spark, SF001)
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet").distinct().count()
    orders = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert s["persons"].count() == s["places"].count() == s["vehicles"].count() == lines
    assert s["accidents"].count() == orders   # every year


def test_sorted_results_come_in_order(spark):
    rows = Q["agg_weather_surface"](spark, SF001).collect()
    assert [r["nb_accidents"] for r in rows] == sorted((r["nb_accidents"] for r in rows), reverse=True)
    rows = Q["agg_department_hour"](spark, SF001).collect()
    assert [r["nb_accidents"] for r in rows] == sorted((r["nb_accidents"] for r in rows), reverse=True)
    rows = Q["topk_groups"](spark, SF001).collect()
    assert [(-r["nb_accidents"], r["dep"]) for r in rows] == sorted((-r["nb_accidents"], r["dep"]) for r in rows)


def test_clean_tables_equals_lazy_driver_silver(spark):
    eager = layers.clean_tables(bindings.raw_tables(spark, SF001))
    lazy = layers.silver_from_driver(spark, SF001)
    assert set(eager) == set(lazy)
    for name in ("accidents", "severity"):
        assert sorted(eager[name].collect()) == sorted(lazy[name].collect())


def test_size_shuffles_from_input(spark):
    from strata.session import size_shuffles
    before = (spark.conf.get("spark.sql.shuffle.partitions"),
              spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        assert size_shuffles(spark, 100 * 1024**4) == 100 * 1024**4 * 2 // (256 * 1024**2) + 1  # 100 TB
        assert size_shuffles(spark, 10 * 1024**2) == 200                                       # floor
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before[1])


def test_gain_reports_significance_only_without_overlap():
    r = {"a": {"median": 2.0, "min": 1.9, "max": 2.1}, "b": {"median": 1.0, "min": 0.9, "max": 1.1},
         "c": {"median": 1.95, "min": 1.8, "max": 2.0}}
    assert measure.gain(r, "a", "b") == {"gain_pct": 50.0, "significant": True}
    assert measure.gain(r, "a", "c")["significant"] is False
