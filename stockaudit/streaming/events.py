"""Event streams: hourly counts, exactly-once intake, activity sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockaudit.streaming.runs import WATERMARK, zoned

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
NIGHT_GAP = "10 hours"


def hourly_counts(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events per hour and type; an hour is final once the watermark has passed its end."""
    return (
        zoned(events, "ts").withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n")
    )


def dedup_events(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return zoned(events, "ts").withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])


def open_sessions(events: DataFrame, gap: str = NIGHT_GAP, watermark: str = WATERMARK) -> DataFrame:
    """Activity sessions per user, closed by a gap as long as the night."""
    # Sessions of one user are merged inside each map task before the shuffle.
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        zoned(events, "ts").withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
        .select("user_id", F.col("session_window.start").alias("session_start"),
                F.col("session_window.end").alias("session_end"), "n")
    )
