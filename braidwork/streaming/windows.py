"""Single-pass kernels as Structured Streaming: the same functions serve batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def hopping(events: DataFrame, size: str = "1 hour", step: str = "30 minutes", late: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.window("ts", size, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")


def first_seen(events: DataFrame, key: list[str], late: str | None = None) -> DataFrame:
    """Events without later ones of the same key (within the watermark, if there is one)."""
    if late:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)
    return events.dropDuplicates(key)
