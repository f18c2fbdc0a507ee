"""Streams: the change log of snapshots, and windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "run_id string, record_id string, kind string, field string, before string, after string, month string"


def change_log(spark: SparkSession, path: str) -> DataFrame:
    """The append-only change log as a stream."""
    return spark.readStream.schema(EVENTS).json(path)


def counts_to(stream: DataFrame, path: str, checkpoint: str):
    """Counts by run and kind, a folder a batch: a batch that is run again replaces its own and no other."""
    def put(batch: DataFrame, epoch: int) -> None:
        batch.groupBy("run_id", "kind").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events (ts, event_type, value) by window and type; what comes later than `late` is dropped.  Streams or not."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
