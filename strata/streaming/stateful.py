"""Windowed counts with state: watermark, RocksDB state store, late rows apart.

Two streams read the same folder of files in the same triggers (files in order of their time, at most
``max_files`` a trigger). One keeps the open windows in Spark's state store: a window closes when the
watermark (the greatest event time of the triggers before, less ``delay``) passes its end, and its state
goes. Rows of a window that was closed in the trigger before are late and not counted: Spark judges a
trigger's rows by the watermark of the one before it. The other stream keeps those rows, by the
same rule, from the greatest event time that it has written for each trigger.
Both write one folder per trigger and overwrite it when a trigger is replayed, so a restart
neither loses nor doubles anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.measure import settings
from strata.streaming.windowed import EVENTS_SCHEMA, finish, ntz_as_utc

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           # no triggers without rows, so that both streams number theirs alike
           "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
COUNTS = "w struct<start: timestamp, end: timestamp>, event_type string, nb long, total double, batch_id long"


def _events(spark: SparkSession, source: str, max_files: int) -> DataFrame:
    tz = spark.conf.get("spark.sql.session.timeZone")
    events = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source)
    return events.withColumn("event_time", ntz_as_utc("ts", tz))


def run_stateful_counts(spark: SparkSession, source: str, out: str, checkpoint: str, window: str = "1 hour", delay: str = "1 day",
                        max_files: int = 1000, state_partitions: int | None = None) -> list[dict]:
    """Count and add up per window and type what is available now, then stop; returns the progress of each
    trigger (rows in state, rows dropped as late). The windows that changed are written per trigger."""
    conf = ROCKSDB | ({"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {})
    counts = (_events(spark, source, max_files).withWatermark("event_time", delay)
              .groupBy(F.window("event_time", window).alias("w"), "event_type")
              .agg(F.count(F.lit(1)).alias("nb"), F.sum("value").alias("total")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with settings(spark, conf):
        q = (counts.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    return [p if isinstance(p, dict) else p.json for p in q.recentProgress]


def read_stateful_counts(spark: SparkSession, out: str) -> DataFrame:
    """The last counts of each window and type: those of its latest trigger."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.read.schema(COUNTS).parquet(out)
    last = rows.groupBy("w", "event_type").agg(F.max_by(F.struct("nb", "total"), "batch_id").alias("last"))
    return finish(last.select("w", "event_type", "last.nb", "last.total"), tz)


def run_late_rows(spark: SparkSession, source: str, out: str, checkpoint: str, window: str = "1 hour", delay: str = "1 day",
                  max_files: int = 1000) -> None:
    """Keep the rows whose window the watermark has passed, per trigger, as they came."""
    greatest = f"{out}/greatest"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("w", F.window("event_time", window))
        seen = spark.createDataFrame([], "greatest timestamp, batch_id long")
        if batch_id > 1:
            seen = spark.read.schema("greatest timestamp, batch_id long").parquet(greatest).where(F.col("batch_id") < batch_id - 1)
        mark = seen.agg((F.max("greatest") - F.expr(f"INTERVAL {delay}")).alias("mark"))   # one row
        late = batch.join(F.broadcast(mark), F.col("w.end") <= F.col("mark")).drop("mark", "event_time")
        late.write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
        batch.agg(F.max("event_time").alias("greatest")).write.mode("overwrite").parquet(f"{greatest}/batch_id={batch_id}")

    q = (_events(spark, source, max_files).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_late_rows(spark: SparkSession, out: str) -> DataFrame:
    """The late events with their window ``w`` and trigger ``batch_id``."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS_SCHEMA.fields)
    return spark.read.schema(f"{fields}, w struct<start: timestamp, end: timestamp>, batch_id long").parquet(f"{out}/late")


def counted_and_late(spark: SparkSession, counts: str, late: str) -> DataFrame:
    """Per window and type: events counted in state and events kept as late."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    counted = read_stateful_counts(spark, counts)
    rest = finish(read_late_rows(spark, late).groupBy("w", "event_type").agg(F.count(F.lit(1)).alias("nb"), F.sum("value").alias("total")), tz)
    key = ["window_start", "window_end", "event_type"]
    met = counted.join(rest.select(*key, F.col("nb").alias("nb_retard")), key, "full")
    return met.select(*key, F.coalesce("nb", F.lit(0)).alias("nb_comptes"), F.coalesce("nb_retard", F.lit(0)).alias("nb_retard"))
