"""Event windows over a stream or a table of (event_id, ts, user_id, event_type, value); beyond the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts and sums per tumbling window and type; rows later than the watermark are dropped on a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", width)
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of a user: a gap ends one."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
