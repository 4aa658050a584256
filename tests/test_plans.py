"""Plan assertions: the physical choices the operators promise."""

from pyspark.sql import functions as F

from strata.plans.explain import plan_text

from strata.operators import aggregate as agg
from strata.operators import measure
from strata.plans import layers
from strata.plans.catalog import QUERIES
from tests.conftest import SF01

Q = QUERIES


def plan(df) -> str:
    return plan_text(df)


def test_broadcast_arm_broadcasts_and_shuffle_arm_does_not(spark):
    assert "BroadcastHashJoin" in plan(Q["join_departments_broadcast"](spark, SF01))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q["join_departments_shuffle"](spark, SF01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_broadcast_guard_falls_back_beyond_bound(spark):
    s = layers.silver_from_driver(spark, SF01)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = agg.departments_with_places(s["accidents"], s["places"], strategy="broadcast",
                                         places_bound_rows=10**12)
        p = plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p


def test_projection_and_filters_reach_the_scan(spark):
    df = Q["rank_departments_serious_rate"](spark, SF01)
    p = plan_text(df)
    # lineitem read with three columns only, orders with four
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_linestatus:string>" in p
    assert "PushedFilters: [IsNotNull(o_" in p


def test_partition_filter_prunes_folders(spark):
    df = Q["pushdown_partition_filter"](spark, SF01)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dep" in p and "(dep#" in p and "= 07)" in p


def test_global_rank_sees_only_k_rows(spark):
    p = plan(Q["rank_departments_serious_rate"](spark, SF01))
    assert "TakeOrderedAndProject(limit=20" in p


def test_no_python_worker_in_native_paths(spark):
    for name in ("rank_departments_serious_rate", "join_severity_by_weather", "clean_report"):
        p = plan(Q[name](spark, SF01))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_salted_aggregate_equals_plain(spark):
    s = layers.silver_from_driver(spark, SF01)
    joined = s["accidents"].select("num_acc", "dep").join(s["places"].select("num_acc"), "num_acc")
    plain = joined.groupBy("dep").agg(F.count(F.lit(1)).cast("bigint").alias("nb_lignes"),
                                      F.count_distinct("num_acc").alias("nb_accidents"))
    salted = measure.salted_aggregate(joined, "dep", "num_acc", 16)
    assert sorted(plain.collect()) == sorted(salted.select(*plain.columns).collect())


def test_severity_groups_are_partially_aggregated(spark):
    p = plan(layers.silver_from_driver(spark, SF01)["severity"])
    assert "partial_max" in p or "partial_count" in p


def test_bucketed_silver_joins_without_shuffle(spark, tmp_path):
    """Silver written bucketed by the key: the severity join reads co-located
    buckets (no Exchange on num_acc on either side)."""
    import re
    from strata.plans import accident_files
    silver = layers.silver_from_driver(spark, SF01)
    silver = {k: silver[k] for k in ("accidents", "severity")}
    back = accident_files.write_silver_bucketed(spark, silver, str(tmp_path), 8, prefix="t_bucketed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = agg.severity_by_weather(back["accidents"], back["severity"])
        p = plan(df)
        rows = sorted(df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p
    assert not re.search(r"Exchange hashpartitioning\(num_acc#\d+L, ", p), p
    expected = sorted(agg.severity_by_weather(*[layers.silver_from_driver(spark, SF01)[k]
                                                for k in ("accidents", "severity")]).collect())
    assert rows == expected


def test_broadcast_guard_is_in_bytes_and_says_so(spark):
    import pytest

    from strata.operators import joins
    path = f"{SF01}/lineitem.parquet"
    assert joins.source_row_bound(spark, path) == 60_000
    keys = spark.range(10).withColumn("t", F.lit("x"))
    assert joins.row_bytes(keys) == 16 + 16 + joins.TEXT_BYTES
    joined = spark.range(10).join(joins.broadcast_if_bounded(keys, 10), "id")
    assert joins.join_strategies(joined) == ["BroadcastHashJoin"]
    with pytest.warns(UserWarning, match="not hinted"):
        joins.broadcast_if_bounded(keys, 10**9)
    with pytest.warns(UserWarning, match="no bound"):
        joins.broadcast_if_bounded(keys, None)


def test_lines_are_exchanged_once_for_all_roles(spark):
    """The three n-sides of the four-table join reuse one exchange of whole lines by the
    accident key; places, vehicles and persons need no other of that size."""
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = Q["join_four_tables"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"FileScan parquet \[l_orderkey", text)) == 1, text
    assert "ReusedExchange" in text


def test_zscore_does_not_shuffle_events(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q["detect_outliers_zscore"](spark, SF01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p


def test_single_partition_exchanges_only_gather_aggregates(spark):
    """Across every catalogue plan, an Exchange SinglePartition always sits on
    aggregated rows (partial aggregates of a global merge, or one row per
    bounded key before a global window), never on raw rows."""
    from strata.plans.explain import SKIP, plan_text
    offenders = []
    for name, q in sorted(Q.items()):
        if name in SKIP:
            continue
        lines = plan_text(q(spark, SF01)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            pos = line.index("Exchange") - 3          # column of this node's "+-" / ":-"
            child = next((ln for ln in lines[i + 1:]
                          if len(ln) > pos + 3 and ln[pos + 3:pos + 5] in ("+-", ":-")), "")
            if not any(op in child for op in ("HashAggregate", "TakeOrderedAndProject")):
                offenders.append((name, child.strip()[:120]))
    assert not offenders, offenders


