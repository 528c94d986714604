"""Streaming counterparts: windowed event counts with late data, sessions, and validation of arriving rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """(start, event_type, n, total): events by window; rows later than `late` are left out."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type")
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events with no gap longer than `gap`."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def once(events: DataFrame, key: str = "event_id", late: str = "10 minutes") -> DataFrame:
    """Events without repeats inside the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def validate_stream(rows: DataFrame, rules: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Appends the issues of every arriving batch to `path`; a batch done twice writes the same folder twice."""

    def check(batch: DataFrame, batch_id: int) -> None:
        rules(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return rows.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
