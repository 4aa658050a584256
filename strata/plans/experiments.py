"""The measured experiments as runnable A/B comparisons.

Each function returns a dict of timings from :func:`strata.operators.measure.time_arms`
(noop sink, warm-up, alternated arms, cache cleared, equal results checked).

* broadcast_vs_shuffle  (M4): the department join with a forced sort-merge arm
  (auto-broadcast disabled before the plan is built) against the size-guarded
  broadcast arm.
* repartition_vs_plain  (M5): repartition-by-key before the aggregate against
  the plain partial/final aggregate, plus the skew profile of the key.
* cache_vs_nocache      (M6): a reused silver table read three times.
* aqe_sweep             (M8): AQE on/off and shuffle partition counts.
* format_sizes          (M10): bytes on disk and re-aggregation time per
  format and codec.
* udf_ways              (U1): the severity score five ways over every row.
* pushdown_bytes        (M9): bytes of the partitioned table against the bytes
  a partition filter reads, filtered aggregate on partitioned vs flat layout.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators import aggregate as agg
from strata.operators import joins, measure
from strata.plans import layers
from strata.session import scratch_path
from strata.sources.files import file_bytes


def broadcast_vs_shuffle(spark: SparkSession, d: str, runs: int = 5) -> dict:
    def arm(strategy: str):
        def build():
            s = layers.silver_from_driver(spark, d)
            bound = joins.source_row_bound(spark, f"{d.rstrip('/')}/lineitem.parquet")
            return agg.departments_with_places(s["accidents"], s["places"], strategy, bound)
        return build
    out = measure.time_arms(spark, {"shuffle": arm("shuffle"), "broadcast": arm("broadcast")}, runs,
                            confs={"shuffle": {"spark.sql.autoBroadcastJoinThreshold": "-1"}})
    out["broadcast_vs_shuffle"] = measure.gain(out, "shuffle", "broadcast")
    out["strategies"] = {}
    for name, conf in (("shuffle", {"spark.sql.autoBroadcastJoinThreshold": "-1"}), ("broadcast", {})):
        with measure.settings(spark, conf):   # which join each arm's plan chose
            out["strategies"][name] = joins.join_strategies(arm(name)())
    return out


def repartition_vs_plain(spark: SparkSession, d: str, runs: int = 5, n: int = 50) -> dict:
    def joined():
        s = layers.silver_from_driver(spark, d)
        return s["accidents"].select("num_acc", "dep").join(s["places"].select("num_acc"), "num_acc")
    arms = {
        "plain": lambda: joined().groupBy("dep").agg(F.count(F.lit(1)).alias("nb")),
        "repartition_first": lambda: joined().repartition(n, "dep").groupBy("dep").agg(F.count(F.lit(1)).alias("nb")),
        "salted": lambda: measure.salted_aggregate(joined(), "dep", "num_acc", 16).select(
            "dep", F.col("nb_lignes").alias("nb")),
    }
    out = measure.time_arms(spark, arms, runs)
    out["repartition_vs_plain"] = measure.gain(out, "plain", "repartition_first")
    out["salted_vs_plain"] = measure.gain(out, "plain", "salted")
    s = layers.silver_from_driver(spark, d)
    prof = {r["measure"]: r.asDict() for r in agg.skew_profile(s["accidents"], s["places"]).collect()}
    out["skew_profile"] = prof
    return out


def cache_vs_nocache(spark: SparkSession, d: str, runs: int = 3) -> dict:
    def reuse(df):
        return df.groupBy("meteo").agg(F.count(F.lit(1)).alias("nb"))

    def no_cache():
        acc = layers.silver_from_driver(spark, d)["accidents"]
        t = [measure.run_noop(reuse(acc)) for _ in range(3)]
        return sum(t) / len(t)

    def with_cache():
        acc = layers.silver_from_driver(spark, d)["accidents"]
        with measure.cached(acc) as c:
            t = [measure.run_noop(reuse(c)) for _ in range(3)]
        return sum(t) / len(t)
    res = {"no_cache": [], "cache": []}
    no_cache(), with_cache()  # warm-up
    for i in range(runs):
        for name, fn in ((("no_cache", no_cache), ("cache", with_cache)) if i % 2 == 0
                         else (("cache", with_cache), ("no_cache", no_cache))):
            spark.catalog.clearCache()
            res[name].append(fn())
    return {k: {"mean_of_3_reads": sorted(v)[len(v) // 2]} for k, v in res.items()}


def aqe_sweep(spark: SparkSession, d: str, runs: int = 3, partitions=(8, 64, 200)) -> dict:
    arms, confs = {}, {}
    for aqe in ("true", "false"):
        for n in partitions:
            name = f"aqe={aqe},partitions={n}"
            arms[name] = lambda: layers.top_departments(layers.silver_from_driver(spark, d))
            confs[name] = {"spark.sql.adaptive.enabled": aqe, "spark.sql.shuffle.partitions": str(n)}
    return measure.time_arms(spark, arms, runs, confs=confs)


def format_sizes(spark: SparkSession, d: str) -> dict:
    acc = layers.silver_from_driver(spark, d)["accidents"]
    out = {}
    for fmt, codec in (("csv", "none"), ("csv", "gzip"), ("json", "none"), ("orc", "snappy"),
                       ("orc", "zstd"), ("parquet", "snappy"), ("parquet", "zstd")):
        path = scratch_path(spark, f"fmt-{fmt}-{codec}")
        w = acc.write.mode("overwrite").format(fmt).option("compression", codec)
        (w.option("header", True) if fmt == "csv" else w).save(path)
        size = file_bytes(spark, path, "part-*")   # data files only, a listing
        r = spark.read.format(fmt).schema(acc.schema)
        # CSV: header names are checked against the schema, not bound by position
        r = r.option("header", True).option("enforceSchema", False) if fmt == "csv" else r
        t0 = time.perf_counter()
        measure.run_noop(r.load(path).groupBy("meteo").agg(F.count(F.lit(1))))
        out[f"{fmt}/{codec}"] = {"bytes": int(size), "reaggregate_sec": round(time.perf_counter() - t0, 3)}
    return out


def pushdown_bytes(spark: SparkSession, d: str, dep: str = "07", runs: int = 3) -> dict:
    """Partition pruning measured: bytes of the whole partitioned table against
    the bytes of the one folder a ``dep = value`` filter reads, and the time
    of the filtered aggregate with and without the partition layout."""
    from strata.operators.joins import source_bytes
    from strata.sources import sinks
    acc = layers.silver_from_driver(spark, d)["accidents"]
    path = scratch_path(spark, "pushdown")
    sinks.write_partitioned(acc, path, ["dep"])
    flat = scratch_path(spark, "pushdown-flat")
    sinks.write_parquet(acc, flat)

    def q(p):
        return (spark.read.schema(acc.schema).parquet(p).where(F.col("dep") == dep)
                .groupBy("meteo").agg(F.count(F.lit(1)).alias("nb")))
    out = measure.time_arms(spark, {"partitioned": lambda: q(path), "flat": lambda: q(flat)}, runs)
    out["partitioned_vs_flat"] = measure.gain(out, "flat", "partitioned")
    out["bytes_total"] = source_bytes(spark, path)
    out["bytes_read_with_filter"] = source_bytes(spark, f"{path}/dep={dep}")
    return out


def udf_ways(spark: SparkSession, d: str, runs: int = 3) -> dict:
    """The severity score of every person five ways (U1): native, Python UDF with pickled and with Arrow rows, pandas
    and Arrow UDF; gains over the pickled way with their ranges."""
    from strata.functions.expressions import severity_score
    from strata.functions.udfs import WAYS
    path = scratch_path(spark, "persons")
    layers.silver_from_driver(spark, d)["persons"].select("num_acc", "grav").write.parquet(path)

    def arm(score):
        return lambda: spark.read.parquet(path).select("num_acc", score("grav").alias("score"))
    out = measure.time_arms(spark, {"native": arm(severity_score), **{name: arm(way) for name, way in WAYS.items()}}, runs)
    out["gains"] = {name: measure.gain(out, "udf_pickled", name) for name in ("native", "udf", "pandas", "arrow")}
    return out


EXPERIMENTS = {"udf_ways": udf_ways, "broadcast_vs_shuffle": broadcast_vs_shuffle, "repartition_vs_plain": repartition_vs_plain,
               "cache_vs_nocache": cache_vs_nocache, "aqe_sweep": aqe_sweep, "format_sizes": format_sizes,
               "pushdown_bytes": pushdown_bytes}


def main() -> None:
    from strata.session import get_session
    ap = argparse.ArgumentParser(description="run the measured experiments")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--master", default=None)
    ap.add_argument("names", nargs="*", default=list(EXPERIMENTS))
    a = ap.parse_args()
    spark = get_session("strata-experiments", master=a.master, cluster=a.master is None)
    for n in a.names:
        print(json.dumps({n: EXPERIMENTS[n](spark, a.sf_dir)}, default=str))


if __name__ == "__main__":
    main()
