"""The pipeline over the accident source files (four semicolon CSV tables).

bronze: the four files, text, bound to their contracts by header name; read once
        into a staging table of distinct rows with their number of copies, from
        which silver, the cleaning report and the unreadable cells are derived;
silver: cleaned (duplicates of whole rows, keys, year range, trims, one row per
        accident key), typed with try_cast, all source columns carried along, plus
        the per-accident severity table; written as Parquet, the accident table
        partitioned by department;
gold:   severity by weather, departments with places, top departments by
        serious rate (and the cleaning report).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import contracts
from strata.functions.expressions import hour_from_hrmn
from strata.operators import aggregate as agg
from strata.operators.clean import CleanRules, clean_report, with_copies
from strata.operators.clean import clean as clean_rows
from strata.plans import layers
from strata.session import scratch_path
from strata.sources import files, sinks

# ---- fixed values: plausible accident years (inclusive) -----------------------
YEAR_RANGE = (2005, 2030)

RULES = {
    "caracteristiques": CleanRules(key="num_acc", ranges={"an": YEAR_RANGE}, trim=("dep",), unique_key=True),
    "lieux": CleanRules(key="num_acc"),
    "vehicules": CleanRules(key="num_acc"),
    "usagers": CleanRules(key="num_acc", required=("grav",)),
}
TYPES = {
    "caracteristiques": {"an": "int", "mois": "int", "jour": "int", "lum": "int", "atm": "int"},
    "lieux": {"surf": "int"},
    "vehicules": {},
    "usagers": {"grav": "int"},
}
# silver table name -> partition columns (only tables that carry them)
SILVER_PARTITIONS = {"accidents": ["dep"]}


def ingest(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read the four files as text by contract; every missing file is named."""
    files.check_sources(spark, list(paths.values()))
    out = {}
    for name, path in paths.items():
        df = files.read_csv_text_contract(spark, path, contracts.SOURCE_CONTRACTS[name])
        out[name] = df.withColumnRenamed("Num_Acc", "num_acc")
    return out


def stage(spark: SparkSession, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Distinct whole rows with ``_copies``, written to a scratch table: the one pass
    over the text and the one exchange of whole rows."""
    out = {}
    for name, df in raw.items():
        path = scratch_path(spark, f"stage-{name}")
        copies = with_copies(df)
        copies.write.parquet(path)
        out[name] = spark.read.schema(copies.schema).parquet(path)
    return out


def clean_sources(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver of raw or of staged tables."""
    def clean(df, rules, types):
        staged = "_copies" in df.columns
        return clean_rows(df.drop("_copies"), rules, types, distinct=staged)

    acc = (clean(raw["caracteristiques"], RULES["caracteristiques"], TYPES["caracteristiques"])
           .withColumn("heure_int", hour_from_hrmn("hrmn")).withColumn("meteo", F.col("atm")))
    places = (clean(raw["lieux"], RULES["lieux"], TYPES["lieux"])
              .withColumn("etat_route", F.col("surf")))
    vehicles = clean(raw["vehicules"], RULES["vehicules"], TYPES["vehicules"])
    persons = clean(raw["usagers"], RULES["usagers"], TYPES["usagers"])
    return {"accidents": acc, "places": places, "vehicles": vehicles, "persons": persons,
            "severity": agg.severity_per_accident(persons)}


def cleaning_report(raw: dict[str, DataFrame]) -> DataFrame:
    parts = [clean_report(raw[n], RULES[n], n, TYPES[n]) for n in raw]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_silver_bucketed(spark: SparkSession, silver: dict[str, DataFrame], out: str,
                          buckets: int, prefix: str = "silver") -> dict[str, DataFrame]:
    """Write every silver table bucketed by the accident key (same bucket
    count for all), and return them read back as tables: the gold joins on
    the key then run bucket to bucket, without a shuffle."""
    back, failed = {}, []
    for name, df in silver.items():
        table = f"{prefix}_{name}"
        try:
            sinks.write_bucketed(df, table, f"{out}/silver_bucketed/{name}", "num_acc", buckets)
            back[name] = spark.table(table)
        except Exception as exc:  # noqa: BLE001 - collected, raised below
            failed.append(f"{name}: {type(exc).__name__}: {exc}")
    if failed:
        raise RuntimeError(f"{len(failed)} table(s) failed to write: {failed}")
    return back


# Incremental layout: silver partitioned by a hash bucket of the key. The bucket
# is a function of the key, so a key never moves between partitions and an
# upsert rewrites only the buckets a delivery touches.
# The number of buckets is fixed with the first delivery, from its size, and kept
# beside the table: about BUCKET_BYTES of text a bucket, with room to grow.
BUCKET_BYTES = 32 * 1024 * 1024
LEAST_BUCKETS = 16


def buckets_for(input_bytes: int) -> int:
    return max(LEAST_BUCKETS, -(-input_bytes // BUCKET_BYTES))


def key_buckets(spark: SparkSession, out: str, input_bytes: int) -> int:
    """The bucket count of the incremental silver below ``out``, decided once."""
    path = f"{out}/silver_incremental_layout"
    if files.missing_paths(spark, [path]):
        spark.createDataFrame([(buckets_for(input_bytes),)], "key_buckets int").coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema("key_buckets int").json(path).first()["key_buckets"]


def with_key_bucket(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("key_bucket", F.pmod(F.xxhash64("num_acc"), F.lit(n)).cast("int"))


def upsert_silver(spark: SparkSession, silver: dict[str, DataFrame], out: str,
                  n_buckets: int) -> dict[str, DataFrame]:
    """Merge a delivery into the incremental silver: for every table, all rows
    of each key the delivery mentions are replaced by the delivered ones (a
    delivery carries, per table, the complete rows of the keys it mentions);
    keys it does not mention are untouched, and so are their buckets. Every table
    is tried; what failed is raised at the end. Returns the merged silver tables read
    back (without the bucket column)."""
    back, failed = {}, []
    for name, df in silver.items():
        path = f"{out}/silver_incremental/{name}"
        rows = with_key_bucket(df, n_buckets)
        try:
            if files.missing_paths(spark, [path]):
                sinks.write_partitioned(rows, path, ["key_bucket"])
            else:
                sinks.upsert_partitions(spark, path, rows, ["num_acc"], "key_bucket")
            back[name] = spark.read.schema(rows.schema).parquet(path).select(*df.columns)
        except Exception as exc:  # noqa: BLE001 - collected, raised below
            failed.append(f"{name}: {type(exc).__name__}: {exc}")
    if failed:
        raise RuntimeError(f"{len(failed)} table(s) failed to merge: {failed}")
    return back


def run_pipeline(spark: SparkSession, paths: dict[str, str], out: str,
                 buckets: int | None = None, mode: str = "overwrite") -> DataFrame:
    """Bronze -> silver -> gold, written under ``out``; returns the status of
    every written table and the cleaning metrics (raises if a write failed).

    ``mode="overwrite"`` rewrites silver (accidents partitioned by department);
    with ``buckets`` silver is also written as tables bucketed by the key and
    gold is computed from them (co-located joins). ``mode="upsert"`` merges the
    delivery into the incremental silver (:func:`upsert_silver`) instead of
    rewriting it; gold is then recomputed from the merged silver."""
    if mode not in ("overwrite", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    timings: list[tuple[str, str, str, int]] = []
    t0 = time.perf_counter()

    def lap(step: str) -> None:
        nonlocal t0
        now = time.perf_counter()
        timings.append((step, "", "duree_ms", int((now - t0) * 1000)))
        t0 = now

    step = ["ingestion"]
    try:
        return _run(spark, paths, out, buckets, mode, lap, timings, step)
    except Exception as error:
        # what is known of a failed run is kept, with its error
        rows = spark.createDataFrame(timings, sinks.METRICS_SCHEMA).unionByName(sinks.failure_rows(spark, step[0], error))
        sinks.write_metrics_json(rows, f"{out}/logs/metrics")
        raise


def _run(spark, paths, out, buckets, mode, lap, timings, step) -> DataFrame:
    raw = stage(spark, ingest(spark, paths))
    lap("ingestion")
    step[0] = "bronze_vers_silver"
    silver = clean_sources(raw)
    if mode == "upsert":
        size = sum(files.file_bytes(spark, p) for p in paths.values())
        back = upsert_silver(spark, silver, out, key_buckets(spark, out, size))
        status = [(n, f"{out}/silver_incremental/{n}", "ok") for n in silver]
    else:
        status = sinks.write_all(silver, f"{out}/silver", partitions=SILVER_PARTITIONS)
        if buckets:
            back = write_silver_bucketed(spark, silver, out, buckets)
        else:
            back = {n: spark.read.schema(df.schema).parquet(f"{out}/silver/{n}").select(*df.columns)
                    for n, df in silver.items()}
    lap("bronze_vers_silver")  # lazy: cleaning and writing run together
    step[0] = "ecriture_gold"
    gold = layers.gold_tables(back)
    status += sinks.write_all(gold, f"{out}/gold", files=1)
    lap("ecriture_gold")
    step[0] = "rapport"
    metrics = sinks.metrics_from_report(cleaning_report(raw), "nettoyage")
    for name in raw:
        if TYPES[name]:
            bad = contracts.bad_cell_counts(raw[name], _typed_contract(name), weight="_copies")
            metrics = metrics.unionByName(bad.select(
                F.lit("typage").alias("step"), F.lit(name).alias("table_name"),
                F.concat(F.lit("cellules_illisibles_"), "column_name").alias("metric"), F.col("bad_cells").alias("value")))
    for name, table in gold.items():   # the analyses' sizes belong to the run's figures
        metrics = metrics.unionByName(spark.read.schema(table.schema).parquet(f"{out}/gold/{name}").agg(
            F.lit("analyse").alias("step"), F.lit(name).alias("table_name"), F.lit("nb_lignes").alias("metric"), F.count(F.lit(1)).alias("value")))
    steps = spark.createDataFrame(timings, sinks.METRICS_SCHEMA)
    sinks.write_metrics_json(metrics.unionByName(steps), f"{out}/logs/metrics")
    return spark.createDataFrame(status, "table_name string, path string, status string")


def _typed_contract(name: str) -> contracts.Contract:
    """The typed columns of a source table, keyed by the renamed key column."""
    return contracts.Contract(name, tuple(contracts.Column(c, t) for c, t in TYPES[name].items()))


def main() -> None:
    import argparse

    from strata.session import get_session, size_shuffles
    ap = argparse.ArgumentParser(description="bronze -> silver -> gold over the four accident files")
    ap.add_argument("--caracteristiques", required=True)
    ap.add_argument("--lieux", required=True)
    ap.add_argument("--vehicules", required=True)
    ap.add_argument("--usagers", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--buckets", type=int, default=None)
    ap.add_argument("--mode", choices=("overwrite", "upsert"), default="overwrite")
    ap.add_argument("--master", default=None)
    a = ap.parse_args()
    spark = get_session("accident-pipeline", master=a.master, cluster=a.master is None)
    paths = {"caracteristiques": a.caracteristiques, "lieux": a.lieux,
             "vehicules": a.vehicules, "usagers": a.usagers}
    # shuffles sized from the input (text: shuffled rows are smaller than the CSV)
    size_shuffles(spark, sum(files.file_bytes(spark, p) for p in paths.values()), expansion=1.0)
    for row in run_pipeline(spark, paths, a.out, buckets=a.buckets, mode=a.mode).collect():
        print(f"{row['table_name']:28s} {row['status']:8s} {row['path']}")
    spark.stop()


if __name__ == "__main__":
    main()
