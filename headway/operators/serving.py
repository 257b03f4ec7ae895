"""Serving layer: the current row per route, merged with history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.delays import live_minutes
from ..functions.numbers import mean_of
from ..functions.text import first_present
from .windows import SIZE


def latest_per_route(windowed: DataFrame, newer: str | None = None) -> DataFrame:
    """Newest window of each route (fixed-width values: hash aggregate, map-side combine).

    ``newer`` names a 0/1 column that decides between two rows of one window.
    """
    order = F.col("window_end")
    if newer is not None:
        order = 2 * F.unix_micros(order.cast("timestamp")) + F.col(newer)
    return (
        windowed.withColumn("_order", order)
        .groupBy("route_id")
        .agg(
            F.max_by("window_start", "_order").alias("window_start"),
            F.max_by("window_end", "_order").alias("window_end"),
            F.max_by("average_delay_seconds", "_order").alias("average_delay_seconds"),
        )
    )


def latest_from_panes(panes: DataFrame, size: str = SIZE) -> DataFrame:
    """The same rows straight from pane sums, without building any window.

    A route's newest window starts at its newest pane and holds no other pane,
    so its average is that pane's.
    """
    newest = panes.groupBy("route_id").agg(
        F.max("pane").alias("window_start"),
        F.max_by("delay_sum", "pane").alias("delay_sum"),
        F.max_by("delay_count", "pane").alias("delay_count"),
    )
    return newest.select(
        "route_id",
        "window_start",
        (F.col("window_start") + F.expr(f"INTERVAL {size}")).alias("window_end"),
        mean_of(F.col("delay_sum"), F.col("delay_count")).alias("average_delay_seconds"),
    )


def known_routes(df: DataFrame, routes: DataFrame, key: str = "route_id") -> DataFrame:
    """Rows whose route is in the dimension.

    No hint: the planner broadcasts a dimension below its size limit, so the
    rows are filtered before any shuffle, and joins a larger one by shuffle.
    """
    names = routes.select(F.col("route").alias(key))
    return df.join(names, key, "left_semi")


def live_value(routes: DataFrame, store: DataFrame) -> DataFrame:
    """Stored text per route: the first key's, else the second's, else NULL."""
    stored = store.select(
        "route", first_present(F.col("live_value"), F.col("fallback_value")).alias("live")
    )
    return routes.join(stored, "route", "left")


def merge_layers(
    routes: DataFrame, store: DataFrame, baselines: DataFrame, default: float = 3.0
) -> DataFrame:
    """Delay in minutes per route: live value, else baseline, else ``default``."""
    return (
        live_value(routes, known_routes(store, routes, "route"))
        .join(baselines, "route", "left")
        .withColumn("baseline_minutes", F.coalesce("baseline_minutes", F.lit(default)))
        .withColumn(
            "delay_minutes",
            live_minutes(F.col("live"), F.col("baseline_minutes")),
        )
    )


def serving_coverage(routes: DataFrame, store: DataFrame) -> DataFrame:
    """Routes, routes with a live value, and their share."""
    covered = F.col("live").isNotNull().cast("int")
    return live_value(routes, known_routes(store, routes, "route")).agg(
        F.count(F.lit(1)).alias("routes"),
        F.sum(covered).alias("covered"),
        F.avg(covered).alias("hit_ratio"),
    )


def lambda_view(history: DataFrame, current: DataFrame) -> DataFrame:
    """History and live delay of every route side by side, and their difference.

    Both sides are already grouped, hence partitioned, by route: the join adds
    no shuffle and meets at most one row per route and side.
    """
    batch = history.select("route_id", "historical_avg_delay", "total_window_batches_analyzed")
    speed = current.select(
        "route_id", F.col("average_delay_seconds").alias("live_delay"), "window_end"
    )
    return batch.join(speed, "route_id", "full").withColumn(
        "live_minus_historical", F.col("live_delay") - F.col("historical_avg_delay")
    )
