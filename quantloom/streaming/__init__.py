"""Streaming variants of event aggregates; run with ``availableNow`` they agree with batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Events from a folder of files, the time column as an instant for the watermark."""
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per type and window; state older than the watermark goes."""
    g = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
    return g.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("v")).select(F.col("w.start").alias("start"), "event_type", "n", "v")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return g.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event id once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
