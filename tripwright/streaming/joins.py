"""Interval joins of two streams with state bounded by the watermark.

Streams meet on the event-time column. To come closest to a
processing-time join, pass the broker's or the ingest time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.operators.events import END, START, interval_join


def _sides(events: DataFrame, delay: str) -> tuple[DataFrame, DataFrame]:
    zoned = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    marked = zoned.withWatermark("event_time", delay)
    kind = F.col("event_type")
    return marked.filter(kind == START), marked.filter(kind == END)


def stream_interval_join(events: DataFrame, within: str = "2 hours", delay: str = "10 minutes") -> DataFrame:
    """Completed trips as they occur; a start leaves the state once its window has passed."""
    starts, ends = _sides(events, delay)
    return interval_join(starts, ends, within=within)


def stream_unmatched(events: DataFrame, within: str = "2 hours", delay: str = "10 minutes") -> DataFrame:
    """Starts whose end did not come in time, once the watermark has passed their window."""
    starts, ends = _sides(events, delay)
    joined = interval_join(starts, ends, within=within, how="left_outer", matched="matched")
    return joined.filter(~F.col("matched")).select(
        "trip_id", "pickup_datetime", "pickup_location_id", "passenger_count"
    )
