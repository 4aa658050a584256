"""Continuous count / sum per event-time window and type.

Source: a file stream (new Parquet files in a folder are new data). Each
micro-batch is aggregated on its own and its partial counts land in their own
``batch_id=N`` folder (overwrite, so a replayed batch is idempotent); the reader
adds the partial counts of all batches. Counts and sums are additive, so the
result does not depend on the order or the batches that events arrive in: no event is
too late, nothing is dropped, and no state has to be kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def ntz_as_utc(col: str, tz: str):
    """NTZ wall-clock -> the TIMESTAMP instant of that wall-clock in UTC,
    whatever the session time zone (a plain cast would read it in the session
    zone and shift hour windows in zones with half-hour offsets)."""
    return F.from_utc_timestamp(F.col(col).cast("timestamp"), tz)


def utc_as_ntz(col: str, tz: str):
    """Inverse of :func:`ntz_as_utc` for window bounds."""
    return F.to_utc_timestamp(F.col(col), tz).cast("timestamp_ntz")


def windowed_counts(events: DataFrame, window: str) -> DataFrame:
    """Rows and total value per (window, event_type) of a batch.

    The NTZ source time is read as a UTC wall-clock (windows align to UTC hours
    in every session zone)."""
    tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    ev = events.withColumn("event_time", ntz_as_utc("ts", tz))
    return (ev.groupBy(F.window("event_time", window).alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("nb"), F.sum("value").alias("total")))


def run_windowed_counts(spark: SparkSession, source: str, out_path: str, checkpoint: str,
                        window: str = "1 hour", max_files_per_trigger: int = 1000) -> None:
    """Run the stream over everything available now, then stop. A backlog is read in
    micro-batches of at most ``max_files_per_trigger`` files."""
    events = (spark.readStream.schema(EVENTS_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        windowed_counts(batch, window).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (events.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


PARTIAL_SCHEMA = "w struct<start: timestamp, end: timestamp>, event_type string, nb long, total double, batch_id long"


def read_windowed_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The counts of each (window, type), added over the micro-batches."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    parts = spark.read.schema(PARTIAL_SCHEMA).parquet(out_path)
    return finish(parts.groupBy("w", "event_type").agg(F.sum("nb").alias("nb"), F.sum("total").alias("total")), tz)


def finish(counts: DataFrame, tz: str) -> DataFrame:
    """Window bounds back to NTZ wall-clock, totals rounded (order-free)."""
    return counts.select(
        utc_as_ntz("w.start", tz).alias("window_start"), utc_as_ntz("w.end", tz).alias("window_end"),
        "event_type", "nb", F.round("total", 6).alias("total"))
