"""Structured Streaming form of the channel × hour sales report.

Events arrive as files; the query keeps per (hour window, event type) sums
in state, bounded by a watermark on the event time, and emits each window
once it can no longer change (append mode). The batch operator
``operators.aggregates.channel_hourly_sales`` answers the same question on
a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event time is read as TIMESTAMP (watermarks need it): the stored wall-clock
# values are taken as UTC instants; ``utc_text`` renders them back in UTC.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def event_stream(spark: SparkSession, directory: str, glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Event files arriving in ``directory`` (only names matching ``glob``)."""
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def utc_text(spark: SparkSession, col, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    """Render a TIMESTAMP as UTC wall-clock text, whatever the session time zone."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.date_format(F.to_utc_timestamp(col, tz), fmt)


def hourly_channel_sales(events: DataFrame, watermark: str = "2 hours",
                         window: str = "1 hour") -> DataFrame:
    """Windowed sums per event type; state older than the watermark is dropped."""
    return (events.where(F.col("event_type").isNotNull() & F.col("ts").isNotNull())
                  .withWatermark("ts", watermark)
                  .groupBy(F.window("ts", window).alias("w"), "event_type")
                  .agg(F.sum("value").alias("sales"), F.count(F.lit(1)).alias("events")))


def run_to_files(spark: SparkSession, directory: str, checkpoint: str, path: str,
                 watermark: str = "2 hours", window: str = "1 hour",
                 glob: str = "*.parquet") -> DataFrame:
    """Process every available file once (availableNow) into Parquet files under ``path``.

    Append mode: a window is written once the watermark has passed it, and its state is dropped, so
    state stays bounded. Windows that are still open when a bounded replay ends are
    answered by the same aggregation over the events after the watermark only; a continuous run
    writes them later. Returns closed and open windows. ``checkpoint`` and ``path`` must be on
    shared storage, so that a restarted query resumes from its committed offsets and state.
    """
    agg = hourly_channel_sales(event_stream(spark, directory, glob), watermark, window)
    q = (agg.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    closed = spark.read.schema(agg.schema).parquet(path)
    passed = next((p["eventTime"]["watermark"] for p in reversed(q.recentProgress)
                   if "watermark" in p.get("eventTime", {})), "1970-01-01T00:00:00.000Z")
    end = F.to_timestamp(F.lit(passed))
    events = spark.read.schema(EVENT_SCHEMA).option("pathGlobFilter", glob).parquet(directory)
    still = hourly_channel_sales(events.where(F.col("ts") >= end - F.expr(f"INTERVAL {window}")),
                                 watermark, window).where(F.col("w.end") > end)
    return closed.unionByName(still)
