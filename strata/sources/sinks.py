"""Sinks: Parquet (plain / partitioned), per-table status, metrics, upsert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Plain Parquet write. ``files`` coalesces only tiny (gold) outputs; big
    tables get a REBALANCE so AQE sizes the files (splits big partitions,
    merges small ones) instead of one writer task."""
    out = df.coalesce(files) if files else df.hint("rebalance")
    out.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite") -> None:
    """Partitioned Parquet: rows are clustered by the partition columns (few
    files per folder) with a REBALANCE, so AQE splits a hot value (say one
    department with a third of the rows) over several writer tasks instead of
    sending it to one."""
    missing = [c for c in partition_cols if c not in df.columns]
    if missing:
        raise ValueError(f"partition column(s) not in table: {missing}")
    (df.hint("rebalance", *partition_cols).write.mode(mode)
     .partitionBy(*partition_cols).parquet(path))


def write_each(tables: Mapping[str, DataFrame], base: str, partitions: dict[str, list[str]] | None = None,
               files: int | None = None) -> list[tuple[str, str, str]]:
    """Write every table, isolating failures: (table, path, status), where the status
    is ``ok`` or ``failed: ...``."""
    partitions = partitions or {}
    status = []
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{name}"
        try:
            if partitions.get(name):
                write_partitioned(df, path, partitions[name])
            else:
                write_parquet(df, path, files=files)
            status.append((name, path, "ok"))
        except Exception as exc:  # noqa: BLE001 - told in the status
            status.append((name, path, f"failed: {type(exc).__name__}: {exc}"))
    return status


def write_all(tables: Mapping[str, DataFrame], base: str, partitions: dict[str, list[str]] | None = None,
              files: int | None = None) -> list[tuple[str, str, str]]:
    """``write_each``, raising once at the end if any table failed, so a run never
    reports success over a missing output."""
    status = write_each(tables, base, partitions, files)
    failed = [s for s in status if s[2] != "ok"]
    if failed:
        raise RuntimeError(f"{len(failed)} table(s) failed to write: {failed}")
    return status


METRICS_SCHEMA = T.StructType([
    T.StructField("step", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("metric", T.StringType()), T.StructField("value", T.LongType()),
])


def metrics_from_report(report: DataFrame, step: str) -> DataFrame:
    """Unpivot a wide count report (table_name + bigint columns) to
    (step, table_name, metric, value) rows."""
    values = [c for c in report.columns if c != "table_name"]
    return (report.unpivot("table_name", values, "metric", "value")
            .select(F.lit(step).alias("step"), "table_name", "metric", F.col("value").cast("bigint")))


def failure_rows(spark: SparkSession, step: str, error: Exception) -> DataFrame:
    """The metrics row of a run that failed: the step, and the error as its name."""
    text = f"erreur: {type(error).__name__}: {str(error).splitlines()[0][:300] if str(error) else ''}"
    return spark.createDataFrame([(step, "", text, 1)], METRICS_SCHEMA)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def write_kept(df: DataFrame, path: str, kept: Column, counts: dict[str, Column], partition_cols: list[str] | None = None) -> dict[str, int]:
    """Write the rows of ``df`` that are ``kept`` as Parquet and count, in the same pass, every row, those kept
    and those of each test in ``counts``. The counts are Spark's observed metrics of the write: the
    source is read once, and they are of the attempt that was committed."""
    seen = Observation("written")
    kept = F.coalesce(kept, F.lit(False))
    tests = {"raw": F.lit(True), "kept": kept, **counts}
    rows = df.observe(seen, *[F.count(F.when(test, F.lit(1))).alias(name) for name, test in tests.items()]).where(kept)
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)
    return dict(seen.get)


def latest_by_key(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """Latest-wins per key (highest ``version``; equal versions are broken by
    the other columns, so the choice is deterministic); a partial per-key
    limit runs before the shuffle."""
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in key and c != version]
    w = Window.partitionBy(*key).orderBy(F.desc(version), *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, key: list[str],
                      partition_col: str, version: str | None = None) -> None:
    """Incremental upsert of a partitioned Parquet table of the schema of
    ``updates``: only partitions that hold a delivered key, or get one, are rewritten.

    With ``version``, stored and delivered rows of a key compete and the highest
    version wins (equal versions: the first by the other columns), so a late, older
    delivery changes nothing. Without it, all stored rows of a delivered key are
    replaced by the delivered ones. A key may move to another partition; a
    partition that loses its last row is removed. Stored partitions are read with the
    declared schema, so text codes like ``07`` stay text.

    The new rows are written to a staging table first, then the touched partitions are
    overwritten. The overwrite is not atomic: if a run breaks in between, run the same
    delivery again (it is idempotent).
    """
    from strata.session import scratch_path
    current = spark.read.schema(updates.schema).parquet(path).select(*updates.columns)
    keys = updates.select(*key).distinct()
    touched = (current.join(keys, key, "left_semi").select(partition_col)
               .union(updates.select(partition_col)).distinct())
    stored = current.join(touched, current[partition_col].eqNullSafe(touched[partition_col]), "left_semi")
    if version:
        merged = latest_by_key(stored.unionByName(updates), key, version)
    else:
        merged = stored.join(keys, key, "left_anti").unionByName(updates)
    staging = scratch_path(spark, "upsert")
    merged.write.parquet(f"{staging}/rows")
    touched.write.parquet(f"{staging}/touched")
    rows = spark.read.schema(updates.schema).parquet(f"{staging}/rows")
    before = spark.read.schema(touched.schema).parquet(f"{staging}/touched")
    left = rows.select(partition_col).distinct()
    empty = before.join(left, before[partition_col].eqNullSafe(left[partition_col]), "left_anti")
    gone = [r[0] for r in empty.collect()]   # partition values: as many as folders
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    for value in gone:
        drop_partition(spark, path, partition_col, value)


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    """Remove one partition folder of a Parquet table."""
    jvm = spark._jvm
    text = None if value is None else str(value)
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, text)
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """External table bucketed and sorted by ``key``: later joins and
    aggregations on ``key`` between tables of the same bucket count read
    co-located buckets and need no shuffle. Rows are dealt by the key first, so
    each bucket is one file."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
