"""The streaming jobs over ride events. Each transform takes a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_ms_to_ts, parse_ts
from .windows import hop, session, tumble


def ride_events(rides: DataFrame) -> DataFrame:
    """Pass-through of decoded rides, with the epoch milliseconds as a timestamp."""
    return rides.select(
        "PULocationID", "DOLocationID", "trip_distance", "total_amount",
        epoch_ms_to_ts("tpep_pickup_datetime").alias("pickup_datetime"))


def green_events(events: DataFrame) -> DataFrame:
    """Decoded green events, with the pickup text as event time."""
    return events.withColumn("event_timestamp", parse_ts("lpep_pickup_datetime"))


def trips_and_revenue(df: DataFrame, ts: str, size: str, key: str, amount: str) -> DataFrame:
    """Trips and revenue per window and location, keyed by window start."""
    return tumble(df, ts, size, [key], {"num_trips": F.count("*"),
                                        "total_revenue": F.sum(amount)}).drop("window_end")


def trips_per_window(df: DataFrame, ts: str, size: str, key: str) -> DataFrame:
    return tumble(df, ts, size, [key], {"num_trips": F.count("*")})


def trips_per_session(df: DataFrame, ts: str, gap: str, key: str) -> DataFrame:
    return session(df, ts, gap, [key], {"num_trips": F.count("*")})


def total_per_window(df: DataFrame, ts: str, size: str, amount: str, name: str) -> DataFrame:
    return tumble(df, ts, size, [], {name: F.sum(amount)})


def trips_per_sliding_window(df: DataFrame, ts: str, size: str, slide: str, key: str) -> DataFrame:
    return hop(df, ts, size, slide, [key], {"num_trips": F.count("*")})


def without_replays(df: DataFrame, key: str) -> DataFrame:
    """Drop repeated records by id, remembering ids for the watermark delay only."""
    return df.dropDuplicatesWithinWatermark([key]) if df.isStreaming else df.dropDuplicates([key])
