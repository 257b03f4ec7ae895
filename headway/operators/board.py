"""Arrival board, hourly profile and vehicle positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import delays, numbers, times
from ..functions.text import element, vehicle_label
from .serving import known_routes

# Minutes between departures, offset of the board's zone.
FREQUENCY = 10
ZONE = "+01:00"


def arrival_board(
    merged: DataFrame, as_of: Column, zone: str = ZONE, every: int = FREQUENCY
) -> DataFrame:
    """Delay, status, next scheduled and expected time of each route.

    ``as_of`` is a zone-less UTC time, a literal or a column.
    """
    minutes = F.col("delay_mins")
    return (
        merged.withColumn(
            "delay_mins", numbers.whole_minutes(numbers.clamp_minutes(F.col("delay_minutes")))
        )
        .withColumn("local_now", times.local_time(as_of, zone))
        .withColumn("scheduled", times.next_slot(F.col("local_now"), every))
        .withColumn("expected", times.plus_minutes(F.col("scheduled"), minutes))
        .select(
            "route",
            "delay_mins",
            delays.status_text(minutes).alias("status"),
            delays.delay_level(minutes).alias("level"),
            times.clock(F.col("scheduled")).alias("scheduled_time"),
            times.clock(F.col("expected")).alias("expected_time"),
            times.minutes_until(F.col("local_now"), F.col("expected")).alias("next_arrival_mins"),
        )
    )


def live_lines(windowed: DataFrame, routes: DataFrame, baselines: DataFrame) -> DataFrame:
    """Windows of known routes with the usual delay beside them; ``windowed`` may be a stream.

    Both dimensions are read again with each batch of a stream, and need no state. No hint: the
    planner broadcasts a dimension below its size limit.
    """
    names = routes.select("route")
    return (
        windowed.withColumnRenamed("route_id", "route")
        .join(names, "route")
        .join(baselines, "route", "left")
        .select("route", "window_start", "window_end", "average_delay_seconds", "baseline_minutes")
    )


def newest_lines(lines: DataFrame, newer: str) -> DataFrame:
    """The line of each route's newest window; ``newer`` (0/1) decides between two of one window."""
    values = [c for c in lines.columns if c not in ("route", newer)]
    line = F.max_by(F.struct(*values), F.struct("window_end", newer))
    return lines.groupBy("route").agg(line.alias("line")).select("route", "line.*")


def lines_to_merge(lines: DataFrame, routes: DataFrame, baselines: DataFrame, default: float = 3.0) -> DataFrame:
    """Delay of every route as ``arrival_board`` takes it: the live line's, else the usual one."""
    live = lines.select("route", (F.col("average_delay_seconds") / 60.0).alias("live"), F.col("baseline_minutes").alias("then"))
    return (
        routes.select("route")
        .join(live, "route", "left")
        .join(baselines, "route", "left")
        .select("route", F.coalesce("live", "then", "baseline_minutes", F.lit(default)).alias("delay_minutes"))
    )


def one_route(board: DataFrame, route: str) -> DataFrame:
    return board.where(F.col("route") == route)


def hourly_profile(telemetry: DataFrame, merged: DataFrame) -> DataFrame:
    """Mean delay in whole minutes (at least 1) of each route and hour of the day.

    All 24 hours of each route of ``merged`` are present; an hour without
    telemetry shows the route's current delay.
    """
    spine = merged.select(
        "route",
        numbers.clamp_minutes(F.col("delay_minutes")).alias("fallback"),
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"),
    )
    hourly = (
        telemetry.withColumnRenamed("route_id", "route")
        .groupBy("route", F.hour("ts").alias("hour"))
        .agg(F.avg("delay_seconds").alias("mean_seconds"))
    )
    minutes = F.coalesce(F.col("mean_seconds") / 60.0, F.col("fallback"))
    return spine.join(hourly, ["route", "hour"], "left").select(
        "route",
        times.hour_label(F.col("hour")).alias("hour_label"),
        F.greatest(F.lit(1), minutes.cast("int")).alias("delay_mins"),
        times.is_peak(F.col("hour")).alias("peak"),
    )


def known_profile(telemetry: DataFrame, merged: DataFrame, routes: DataFrame) -> DataFrame:
    """Hourly profile that drops telemetry of unknown routes before the shuffle."""
    return hourly_profile(known_routes(telemetry, routes), merged)


def route_path(routes: DataFrame, paths: DataFrame, default: list[list[float]]) -> DataFrame:
    """Path of each route, or the default path."""
    points = F.array(*[F.array(*[F.lit(x) for x in point]) for point in default])
    return routes.join(paths, "route", "left").withColumn(
        "path", F.coalesce("path", points)
    )


def path_points(paths: DataFrame) -> DataFrame:
    """One row per path point, numbered from 0."""
    return paths.select("*", F.posexplode("path").alias("pos", "point")).drop("path")


def place_vehicles(paths: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Vehicle rows on the path points their ``pos`` names."""
    others = [c for c in paths.columns if c not in ("route", "path")]
    return (
        path_points(paths)
        .join(vehicles, "pos")
        .select(
            "route",
            *others,
            vehicle_label(F.col("route"), F.col("suffix")).alias("vehicle_id"),
            element(F.col("point"), 0).alias("lon"),
            element(F.col("point"), 1).alias("lat"),
            "speed",
            "status",
        )
    )
