"""Event-time state on streams of clicks: hourly windows, and each event once.

An event is late when it arrives behind the watermark, the newest event time of earlier arrivals less ``delay``.  Late
events are dropped by the state operators; what they keep is bounded by the events of the last ``delay``, not by the
age of the stream.  Windows are written once, when the watermark has passed their end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import standardize_strings
from tidemark.plans.silver import CONVERSION_EVENTS
from tidemark.schemas import SOURCES
from tidemark.streaming.ingest import file_stream


@dataclass(frozen=True)
class Drained:
    """What one run of a stateful stream did: rows read, rows dropped as late, rows held in state at its end."""

    read: int
    late: int
    held: int


def click_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Clicks with a type and a time, labels trimmed and in lower case."""
    raw = file_stream(spark, landing, "clickstream", SOURCES["clickstream"].schema, max_files)
    rows = standardize_strings(raw, ("event_type", "device_type"))
    return rows.where(F.col("event_type").isNotNull() & F.col("timestamp").isNotNull())


def hourly_windows(clicks: DataFrame, delay: str) -> DataFrame:
    """Traffic by hour and device of the events that were in time.

    Two aggregations follow each other: the first holds one row per hour, device and session, so a session counts once
    without a set of sessions in any row; the second adds those rows up.
    """
    event = F.col("event_type")
    by_session = (
        clicks.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 hour").alias("hour"), "device_type", "session_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(event == "page_view").alias("views"),
            F.count_if(event == "purchase").alias("bought"),
            F.count_if(event.isin(*CONVERSION_EVENTS)).alias("converted"),
        )
    )
    hours = by_session.groupBy(F.window("hour", "1 hour").alias("window"), "device_type").agg(
        F.sum("events").alias("total_events"),
        F.count("session_id").alias("unique_sessions"),
        F.sum("views").alias("page_views"),
        F.sum("bought").alias("purchases"),
        F.sum("converted").alias("conversions"),
    )
    return hours.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *hours.columns[1:])


def distinct_events(clicks: DataFrame, delay: str, key: str = "event_id") -> DataFrame:
    """Each event in time once; a key is remembered until the watermark is ``delay`` past its event."""
    return clicks.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark([key])


def drain(stateful: DataFrame, target: str, checkpoint: str) -> Drained:
    """Take in all that has arrived, append what is complete to ``target`` and stop.

    The checkpoint holds state, watermark and the files read, so a later call goes on where this one ended; the file
    sink's log keeps a repeated batch from being seen twice.
    """
    writer = stateful.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", checkpoint).option("path", target).start()
    query.awaitTermination()
    return _drained(query)


def _drained(query: StreamingQuery) -> Drained:
    batches = query.recentProgress
    operators = [o for b in batches for o in b.stateOperators]
    last = batches[-1].stateOperators if batches else []
    return Drained(sum(b.numInputRows for b in batches), sum(o.numRowsDroppedByWatermark for o in operators), sum(o.numRowsTotal for o in last))
