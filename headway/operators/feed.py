"""Nested feed snapshots to flat stop updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.delays import stop_delay


def flatten_feed(feed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per stop update of the entities that hold a trip update.

    Every record carries its poll's time. Only ``explode`` and projections, so
    no shuffle, in batch and stream.
    """
    trips = (
        feed.select("poll_ts", *keep, F.explode("entity").alias("entity"))
        .select("poll_ts", *keep, F.col("entity.trip_update").alias("trip_update"))
        .where(F.col("trip_update").isNotNull())
    )
    stops = trips.select(
        "poll_ts", *keep, "trip_update.trip", F.explode("trip_update.stop_time_update").alias("stop")
    )
    return feed_payload(stops, keep)


def unpack_feed(decoded: DataFrame, feed: str = "feed") -> DataFrame:
    """A decoded feed message (``sources.files.decode_feed``) as ``flatten_feed`` takes it: its header's
    time and its entities."""
    return decoded.select(
        F.col(f"{feed}.header.timestamp").cast("bigint").alias("poll_ts"), F.col(f"{feed}.entity").alias("entity")
    )


def feed_payload(stops: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat payload of a stop update: text ids, whole time and delay."""
    return stops.select(
        *keep,
        F.col("poll_ts").cast("bigint").alias("timestamp"),
        F.col("trip.route_id").cast("string").alias("route_id"),
        F.col("trip.trip_id").cast("string").alias("trip_id"),
        F.col("stop.stop_id").cast("string").alias("stop_id"),
        stop_delay(F.col("stop.departure"), F.col("stop.arrival"))
        .cast("int")
        .alias("delay_seconds"),
    )
