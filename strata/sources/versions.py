"""Partitions replaced in one step: new folders are complete before the table names them.

The table is external and its partitions are kept in the session's catalog, each with the folder that holds
its rows. New rows go to a folder of their own; then the touched partitions are pointed there, one
statement each, on metadata alone. A run that breaks before leaves the old rows readable, and one that
breaks in between is run again. Old folders stay until ``unused_folders`` are cleaned by the owner.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def create(spark: SparkSession, table: str, path: str, like: DataFrame, partition_col: str) -> None:
    """An empty Parquet table with the columns of ``like``, the partition column last."""
    fields = [f for f in like.schema.fields if f.name != partition_col] + [like.schema[partition_col]]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{partition_col}`) LOCATION '{path}'")


def stage(df: DataFrame, path: str, partition_col: str) -> str:
    """Write the new rows to a folder that no reader knows."""
    folder = f"{path.rstrip('/')}/versions/{uuid.uuid4().hex}"
    # the folder's name tells nothing about the value, so the column stays in the files' path only as a number
    numbered = df.withColumn("_part", F.coalesce(F.col(partition_col).cast("string"), F.lit(NULL_PARTITION)))
    numbered.hint("rebalance", "_part").write.partitionBy("_part").parquet(folder)
    return folder


def switch(spark: SparkSession, table: str, folder: str, partition_col: str) -> list[str | None]:
    """Point every partition that the folder holds there; returns their values (as many as folders)."""
    found = spark.read.schema("_part string").parquet(folder).distinct().collect()
    values = [NULL_PARTITION if r[0] is None else r[0] for r in found]
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for value in sorted(values):
        name = "NULL" if value == NULL_PARTITION else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        place = f"{folder}/{escape('_part', value)}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (`{partition_col}` = {name}) LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {table} PARTITION (`{partition_col}` = {name}) SET LOCATION '{place}'")
    return [None if v == NULL_PARTITION else v for v in sorted(values)]


def replace_partitions(spark: SparkSession, table: str, path: str, df: DataFrame, partition_col: str) -> list[str | None]:
    """Replace the partitions that ``df`` has rows of; the others stay."""
    return switch(spark, table, stage(df, path, partition_col), partition_col)


def drop_partitions(spark: SparkSession, table: str, partition_col: str, values: list[str]) -> None:
    """Take partitions out of the table; their folders stay."""
    for value in values:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{partition_col}` = '{value}')")


def write_clustered(df: DataFrame, path: str, by: list[str | Column], bloom: list[str] = (), files: int | None = None) -> None:
    """Parquet laid out by range of the columns and sorted in each file, so that a filter on them skips files' row
    groups by their least and greatest values; ``bloom`` columns get Bloom filters, by which a search for
    single values skips row groups whatever their order."""
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = dealt.sortWithinPartitions(*by).write.mode("overwrite")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
