"""Stream joined with a table that may change: every trigger reads the table as it is then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.streaming.windowed import EVENTS_SCHEMA


def run_enriched(spark: SparkSession, source: str, static: str, static_schema: str, key: str, out: str, checkpoint: str,
                 max_files: int = 1000) -> None:
    """Join what is available now of a file stream of events with the Parquet table ``static`` (one row per
    key; events without one keep nulls), then stop. The table is listed and read anew in each trigger. Each
    trigger writes its own folder and overwrites it when it is replayed."""
    events = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        table = spark.read.schema(static_schema).parquet(static)
        batch.join(table, key, "left").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = (events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_enriched(spark: SparkSession, out: str, static_schema: str, key: str) -> DataFrame:
    """The joined events of all triggers, with ``batch_id``."""
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS_SCHEMA.fields)
    rest = ", ".join(c for c in static_schema.split(", ") if c.split(" ")[0] != key)
    return spark.read.schema(f"{own}, {rest}, batch_id long").parquet(out)
