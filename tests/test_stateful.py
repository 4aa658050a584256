"""Stateful counts: several triggers in shuffled order, late rows kept apart, state bounded, restarts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.streaming import stateful
from strata.streaming.windowed import finish, windowed_counts


def arrivals(spark, path, days, mode="append"):
    """One file per day, in the order given; some of each day's events are five days old."""
    for day in days:
        rng = random.Random(day)
        rows = []
        for k in range(200):
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=day - (5 if k % 20 == 0 else 0), seconds=rng.randrange(86_400))
            rows.append((day * 1000 + k, ts, k % 7, rng.choice(["view", "click"]), float(k), None))
        df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        df.coalesce(1).write.mode(mode).parquet(path)


def run(spark, source, out, delay="2 days"):
    progress = stateful.run_stateful_counts(spark, source, f"{out}/counts", f"{out}/ckpt", "1 hour", delay, 1, 4)
    stateful.run_late_rows(spark, source, f"{out}/late", f"{out}/late-ckpt", "1 hour", delay, 1)
    return progress


def batch(spark, source):
    tz = spark.conf.get("spark.sql.session.timeZone")
    return finish(windowed_counts(spark.read.schema(stateful.EVENTS_SCHEMA).parquet(source), "1 hour"), tz)


def check(spark, source, out):
    told = {tuple(r)[:3]: (r.nb_comptes, r.nb_retard) for r in stateful.counted_and_late(spark, f"{out}/counts", f"{out}/late").collect()}
    want = {(r.window_start, r.window_end, r.event_type): r.nb for r in batch(spark, source).collect()}
    assert {k: a + b for k, (a, b) in told.items()} == want
    return sum(b for _, b in told.values())


def test_counted_and_late_rows_are_the_batch(spark):
    source, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    arrivals(spark, source, [0, 1, 3, 2, 4, 6, 5, 7, 8, 9, 11, 10])
    progress = run(spark, source, out)
    late = check(spark, source, out)
    assert late > 0 and len([p for p in progress if p["numInputRows"]]) == 12
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) > 0
    # the state holds the open windows only: a few days of hours and types, not all twelve days
    assert max(s["numRowsTotal"] for p in progress for s in p["stateOperators"]) < 24 * 2 * 9
    assert all(r.ts is not None for r in stateful.read_late_rows(spark, f"{out}/late").collect())


def test_a_restart_goes_on(spark):
    source, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    arrivals(spark, source, [0, 2, 4])
    run(spark, source, out)
    arrivals(spark, source, [1, 6, 3, 8])
    run(spark, source, out)
    assert check(spark, source, out) > 0


def test_nothing_is_late_within_the_delay(spark):
    source, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    arrivals(spark, source, [3, 0, 2, 1])
    run(spark, source, out, "30 days")
    assert check(spark, source, out) == 0
    counts = stateful.read_stateful_counts(spark, f"{out}/counts")
    assert counts.exceptAll(batch(spark, source)).isEmpty() and counts.agg(F.sum("nb")).first()[0] == 800
