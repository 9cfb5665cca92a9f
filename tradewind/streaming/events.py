"""Event feed as streams: windowed counts, session summaries, de-duplicated ingest.

Each function takes a streaming (or batch) frame and returns the transformed one; ``run_available``
drives a stream over what is there now and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.temporal import plus
from tradewind.operators.lifecycle import EVENT_TTL
from tradewind.session import workspace


def event_counts(events: DataFrame, every: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Events per type and tumbling window; rows later than the allowed lateness are dropped."""
    return (
        events.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", every).alias("window"), "event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("window.start").alias("window_start"), "event_type", "count")
    )


def session_summaries(events: DataFrame, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Runs of a customer's events with no pause of ``gap``: how many, start and end."""
    return (
        events.withWatermark("timestamp", lateness)
        .groupBy(F.session_window("timestamp", gap).alias("window"), "customer_unique_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            "customer_unique_id",
            F.col("window.start").alias("session_start"),
            F.col("window.end").alias("session_end"),
            "events",
        )
    )


def deduplicated(events: DataFrame, keys: list[str], lateness: str = "1 hour") -> DataFrame:
    """First arrival of every key within the allowed lateness, with its expiry."""
    once = events.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(keys)
    return once.withColumn("ttl_expire", plus("timestamp", EVENT_TTL))


def advance(stream: DataFrame, root: str) -> DataFrame:
    """Process what is new since the last run with this folder, and return all rows delivered so far.

    The folder holds the delivered rows and the stream's checkpoint, so a run reads only files that no run has read.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True)
        .start(f"{root}/rows")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/rows")


def run_available(spark: SparkSession, stream: DataFrame, purpose: str) -> DataFrame:
    """Process everything available into Parquet files in the shared folder and return them as a frame."""
    return advance(stream, workspace(spark, purpose))


def open_counts(spark: SparkSession, root: str) -> DataFrame:
    """The windows that ``event_counts`` holds in its state: those the watermark has not passed."""
    held = spark.read.format("statestore").load(f"{root}/state")
    return held.select(F.col("key.window.start").alias("window_start"), "key.event_type", "value.count")


def open_sessions(spark: SparkSession, root: str) -> DataFrame:
    """The sessions that ``session_summaries`` holds in its state."""
    held = spark.read.format("statestore").load(f"{root}/state")
    window = "value.session_window"
    return held.select(
        "value.customer_unique_id",
        F.col(f"{window}.start").alias("session_start"),
        F.col(f"{window}.end").alias("session_end"),
        F.col("value.count").alias("events"),
    )


def with_open(delivered: DataFrame, held: DataFrame) -> DataFrame:
    """What a run has delivered and what is still in its state, with a flag ``open``.

    The state is read from the stream's checkpoint and stays as it is: the next run goes on from it and delivers what closes.
    """
    return delivered.withColumn("open", F.lit(False)).unionByName(held.withColumn("open", F.lit(True)))
