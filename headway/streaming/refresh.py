"""History kept up to date: sums per date and route, of which only changed dates are made again.

The averages of the batch layer are sums over counts, and both add up over dates. The
store holds them per date and route as batches of a lake of its own; its log names the
lake batches that are in them. A refresh takes from the lake's log the dates that later
batches touched, reads only those dates, and writes their sums; a reader takes the
newest sums of each date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round2
from ..operators.history import latest
from . import sinks
from .commits import CommitLog

SUMS = ("delay_total", "delays", "windows")
LAKE, STORE = -1, -2  # the lake's compaction and the store's own batch, among the runs a store has taken in


def date_sums(windows: DataFrame) -> DataFrame:
    """Sum and number of the averages, and number of rows, per date and route (NULL is a route)."""
    return windows.groupBy("event_date", "route_id").agg(
        F.sum("average_delay_seconds").alias("delay_total"),
        F.count("average_delay_seconds").alias("delays"),
        F.count(F.lit(1)).alias("windows"),
    )


def changed_dates(spark: SparkSession, lake: str, store: str) -> list[str] | None:
    """Dates that lake batches touched since the last refresh; None if the log no longer tells (then all)."""
    live, taken = CommitLog(spark, lake).live(), CommitLog(spark, store).live().covers
    if not taken or live.number != taken.get(LAKE, 0):
        behind = {run: batch for run, batch in live.covers.items() if taken.get(run, -1) < batch}
        if not taken or behind:  # a compaction took in batches that no refresh has seen
            return None
    since = [b for b in live.batches if b[1] > taken.get(b[0], -1)]
    return sorted({d for _, _, _, dates, _ in since for d in dates})


def refresh_history(spark: SparkSession, lake: str, store: str) -> list[str] | None:
    """Bring the store up to the lake of windows; returns the dates read (None: all of them).

    Made again after a failure, a refresh writes the same sums once more. One refresh runs at a time.
    """
    live, log = CommitLog(spark, lake).live(), CommitLog(spark, store)
    before = log.live()
    dates = changed_dates(spark, lake, store)
    windows = sinks.read_snapshots(spark, lake)
    if dates is not None:
        windows = windows.where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
    batch = before.covers.get(STORE, -1) + 1
    sinks.commit_batch(date_sums(windows), f"{store}/sums", 0, batch)
    log.cover(before, None, live.reached | {LAKE: live.number, STORE: batch})
    return dates


def read_history(spark: SparkSession, store: str) -> DataFrame:
    """Average (two decimals) and number of rows per route, as ``history.route_history`` gives them."""
    live = CommitLog(spark, f"{store}/sums").live()
    rows = sinks.committed(spark, f"{store}/sums", live)
    newest = latest(rows, ("event_date", "route_id"), SUMS, F.col("batch_id"))
    return newest.groupBy("route_id").agg(
        round2(F.sum("delay_total") / F.sum("delays")).alias("historical_avg_delay"),
        F.sum("windows").alias("total_window_batches_analyzed"),
    )
