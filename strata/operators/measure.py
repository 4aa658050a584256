"""Physical-control operators and an honest A/B timing harness.

* :func:`cached` scopes a persist: released on exit, always.
* :func:`salted_aggregate` spreads a hot group over ``n`` salts before the
  shuffle and folds the partial results back, exactly.
* :func:`time_arms` times plans with the ``noop`` sink (the whole plan runs;
  ``count()`` would let Catalyst drop aggregates and sorts), warms up once,
  alternates the arms, clears the cache between runs, and checks that the arms
  return the same rows (by an order-insensitive hash computed in Spark).
"""

from __future__ import annotations

import contextlib
import statistics
import time
from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` for the block, materialise it once, always unpersist."""
    p = df.persist(level)
    try:
        p.write.format("noop").mode("overwrite").save()
        yield p
    finally:
        p.unpersist(blocking=True)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the block; the values from before come back after it."""
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        _restore(spark, saved)


def salt_column(key: str | Column, n: int) -> Column:
    """Deterministic salt in [0, n) from a row-level column."""
    c = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(c), F.lit(n))


def salted_aggregate(df: DataFrame, group: str, distinct_key: str, n_salts: int) -> DataFrame:
    """Rows and exact distinct ``distinct_key`` per ``group`` via salting.

    The salt is a function of ``distinct_key``, so each distinct value lives in
    exactly one (group, salt) cell: distinct counts add up across salts. A group
    holding a third of all rows is split into ``n_salts`` shuffle keys.
    """
    salted = df.withColumn("_salt", salt_column(distinct_key, n_salts))
    part = (salted.groupBy(group, "_salt")
            .agg(F.count(F.lit(1)).alias("_rows"), F.count_distinct(distinct_key).alias("_distinct")))
    return (part.groupBy(group)
            .agg(F.sum("_rows").cast("bigint").alias("nb_lignes"),
                 F.sum("_distinct").cast("bigint").alias("nb_accidents")))


def aggregate_then_repartition(df: DataFrame, group: str, n: int) -> DataFrame:
    """Count per group, then lay the (small) result out on ``n`` partitions by
    group. Repartitioning raw rows by a skewed key before aggregating would send
    a hot group's rows to one task; aggregating first sends one partial row
    per map task."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("nb")).repartition(n, group)


def result_fingerprint(df: DataFrame) -> tuple[int, int]:
    """(rows, order-insensitive hash) computed in Spark, one small row back."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("h")).first()
    return int(r["n"]), int(r["h"] or 0)


def run_noop(df: DataFrame) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def time_arms(spark: SparkSession, arms: dict[str, Callable[[], DataFrame]], runs: int = 5,
              confs: dict[str, dict[str, str]] | None = None, check_equal: bool = True) -> dict:
    """Median/min/max seconds per arm. ``confs`` are set **before** each arm's
    plan is built (e.g. the shuffle arm disables auto-broadcast)."""
    confs = confs or {}

    def build(name: str) -> tuple[DataFrame, dict[str, str | None]]:
        saved = {k: spark.conf.get(k, None) for k in confs.get(name, {})}
        for k, v in confs.get(name, {}).items():
            spark.conf.set(k, v)
        try:
            return arms[name](), saved
        except Exception:
            _restore(spark, saved)
            raise

    times: dict[str, list[float]] = {n: [] for n in arms}
    prints = {}
    for name in arms:  # warm-up, and result check
        df, saved = build(name)
        try:
            run_noop(df)
            if check_equal:
                prints[name] = result_fingerprint(df)
        finally:
            _restore(spark, saved)
    for i in range(runs):
        order = list(arms) if i % 2 == 0 else list(reversed(list(arms)))
        for name in order:
            spark.catalog.clearCache()
            df, saved = build(name)
            try:
                times[name].append(run_noop(df))
            finally:
                _restore(spark, saved)
    out = {n: {"median": statistics.median(t), "min": min(t), "max": max(t)} for n, t in times.items()}
    if check_equal:
        out["equal_results"] = len(set(prints.values())) == 1
    return out


def gain(result: dict, baseline: str, candidate: str) -> dict:
    """Gain of ``candidate`` over ``baseline`` in % of the baseline median; it
    counts as significant only when the two arms' [min, max] ranges do not
    overlap."""
    b, c = result[baseline], result[candidate]
    pct = (b["median"] - c["median"]) / b["median"] * 100 if b["median"] > 0 else None
    return {"gain_pct": None if pct is None else round(pct, 1),
            "significant": c["max"] < b["min"] or b["max"] < c["min"]}


def _restore(spark: SparkSession, saved: dict[str, str | None]) -> None:
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
