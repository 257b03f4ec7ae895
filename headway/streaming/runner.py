"""Starting, watching and stopping streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

Trigger = dict | None

# Work off what is there, then stop; ``None`` runs as fast as possible.
ONCE: Trigger = {"availableNow": True}


def every(interval: str) -> Trigger:
    return {"processingTime": interval}


def writer(df: DataFrame, checkpoint: str, mode: str, trigger: Trigger = None) -> DataStreamWriter:
    """A stream writer with a durable checkpoint, so a restart goes on where it ended."""
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return out.trigger(**trigger) if trigger else out


def each_batch(
    df: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: Trigger = None,
    skip_empty: bool = True,
) -> StreamingQuery:
    """Call ``fn(batch, batch_id)`` for each batch, by default only if it holds rows.

    A batch may be delivered again after a failure, so ``fn`` has to overwrite
    what it wrote for the same id. The look for a first row is an action of
    its own: it updates the state of at least one partition a second time (and
    ``isEmpty`` that of all), so sinks of aggregates leave it out and accept
    an empty result.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not skip_empty or batch.take(1):
            fn(batch, batch_id)

    return writer(df, checkpoint, mode, trigger).foreachBatch(guarded).start()


def run_complete(
    df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """Hand the whole aggregate to ``fn`` after every batch."""
    return each_batch(df, fn, checkpoint, "complete", trigger, skip_empty=False)


def stop_all(queries: Iterable[StreamingQuery], timeout: int = 60) -> None:
    """Stop what still runs and wait for it."""
    for query in queries:
        if query.isActive:
            query.stop()
        query.awaitTermination(timeout)


def finish(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; its failure is raised here."""
    query.awaitTermination()


def counted(df: DataFrame, **figures: Column) -> DataFrame:
    """A stream that tells each batch's figures (aggregates by name) to ``ProgressTable`` as it is worked off."""
    return df.observe("batch", *(figure.alias(name) for name, figure in figures.items()))


class ProgressTable(StreamingQueryListener):
    """Writes a row per batch of the queries it watches to a JSON table, for as long as they run.

    ``recentProgress`` holds the last hundred batches of one process; this table
    holds all, also after a restart: query, run, batch, rows read, milliseconds,
    late rows the state dropped, and the figures of ``counted``.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.ended = spark, path, set()
        spark.streams.addListener(self)

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until a query that ended has all its rows in the table."""
        end = time.monotonic() + seconds
        while str(query.runId) not in self.ended and time.monotonic() < end:
            time.sleep(0.05)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get("batch")
        values = {
            "query": str(p.id),
            "run": str(p.runId),
            "batch_id": p.batchId,
            "rows_in": p.numInputRows,
            "milliseconds": p.durationMs.get("triggerExecution", 0),
            "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            **(seen.asDict() if seen is not None else {}),
        }
        row = self.spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
        row.coalesce(1).write.mode("append").json(self.path)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def batch_counts(query: StreamingQuery) -> list[tuple[int, int]]:
    """Batch id and input rows of the recent batches."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]


def batch_durations(query: StreamingQuery) -> list[tuple[int, int]]:
    """Batch id and milliseconds from trigger to commit of the recent batches."""
    return [(p["batchId"], p["durationMs"].get("triggerExecution", 0)) for p in query.recentProgress]
