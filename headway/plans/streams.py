"""Streaming queries: each works off a whole table, then reads what was written.

``availableNow`` takes all files there are and stops, so the results can be
compared with the batch queries. On a running topic only source and trigger
differ.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, parse, windows
from ..session import prepare, shared_folder
from ..sources import dims, files
from ..streaming import refresh, sinks
from ..streaming.runner import ONCE, ProgressTable, counted, each_batch, finish
from . import views
from .batch import as_of, zoneless

# Files, and so batches, of the registered streams.
FILES = 3
LATE = "10 minutes"
LATE_CUT = "2024-01-15 00:00:00"


def _zoned(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _in_files(spark: SparkSession, rows: DataFrame, n: int = FILES) -> DataFrame:
    """A table as a stream of ``n`` files of mixed times, a file for each batch."""
    folder = shared_folder(spark, "source")
    rows.repartition(n).write.parquet(folder)
    return files.read_table_stream(spark, folder, rows.schema, per_trigger=1)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_files(spark, views.table(spark, sf_dir, "events"))


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoned(views.as_telemetry(_events(spark, sf_dir)))


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_avg(clean.clean_telemetry(_telemetry(spark, sf_dir)))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.as_payloads(views.as_telemetry(_events(spark, sf_dir))).select("payload")


def _to_lake(spark: SparkSession, averages: DataFrame, mode: str) -> DataFrame:
    folder = shared_folder(spark, "lake")
    finish(
        sinks.write_lake(averages, f"{folder}/data", f"{folder}/checkpoint", mode, trigger=ONCE)
    )
    return zoneless(sinks.read_snapshots(spark, f"{folder}/data").drop("event_date"))


def stream_sliding_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode: the whole aggregate after each batch."""
    return _to_lake(spark, _windowed(spark, sf_dir), "snapshot")


def stream_upsert_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: the changed windows only."""
    return _to_lake(spark, _windowed(spark, sf_dir), "upsert")


def _to_pane_lake(spark: SparkSession, rows: DataFrame) -> DataFrame:
    folder = shared_folder(spark, "panes")
    sums = windows.pane_sums(clean.clean_telemetry(rows))
    finish(sinks.write_lake(sums, f"{folder}/data", f"{folder}/checkpoint", trigger=ONCE))
    return zoneless(sinks.read_panes(spark, f"{folder}/data"))


def stream_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pane sums in state and lake, rolled up to sliding averages on read."""
    return _to_pane_lake(spark, _telemetry(spark, sf_dir))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected payloads of a topic, by reason."""
    folder = shared_folder(spark, "rejects")
    rows = views.as_payloads(views.as_telemetry(_events(spark, sf_dir)))
    parsed = parse.parse_telemetry(rows, keep=("event_id",))
    finish(sinks.write_rejects(parsed, f"{folder}/data", f"{folder}/checkpoint", ONCE))
    return spark.read.parquet(f"{folder}/data").select("event_id", "reason")


def stream_speed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of a topic to averages: text, parse, clean, pane sums, lake, windows."""
    records = _payloads(spark, sf_dir).select(F.col("payload").cast("binary").alias("value"))
    return _to_pane_lake(spark, parse.parse_telemetry(parse.payload_text(records)))


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode with a watermark, and a restart between two deliveries.

    The second delivery also brings a third of the older rows, too late for
    the windows the watermark has closed.
    """
    folder = shared_folder(spark, "late")
    rows = _zoned(views.cleaned(spark, sf_dir))
    on_time = (F.col("ts") < F.lit(LATE_CUT).cast("timestamp")) & (F.col("event_id") % 3 != 0)
    for name, part in (("first", rows.where(on_time)), ("second", rows.where(~on_time))):
        part.write.parquet(f"{folder}/source/{name}")
        source = files.read_table_stream(spark, f"{folder}/source/*", rows.schema)
        averages = windows.sliding_avg(source, late=LATE)
        finish(
            sinks.write_lake(
                averages, f"{folder}/data", f"{folder}/checkpoint", "final", trigger=ONCE
            )
        )
    written = spark.read.parquet(f"{folder}/data")
    return zoneless(
        written.select("route_id", "window_start", "window_end", "average_delay_seconds")
    )


def stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "serving")
    finish(
        sinks.upsert_serving(
            _windowed(spark, sf_dir), f"{folder}/data", f"{folder}/checkpoint", ONCE
        )
    )
    return zoneless(sinks.read_serving(spark, f"{folder}/data"))


def stream_named_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table by its name, ranked."""
    folder = shared_folder(spark, "named")
    name = f"serving_{uuid.uuid4().hex}"
    finish(
        sinks.serve_named(
            _windowed(spark, sf_dir), name, f"{folder}/data", f"{folder}/checkpoint", ONCE
        )
    )
    return zoneless(windows.top_delays(files.serving_view(spark, name)))


def _both(spark: SparkSession, lake: str, current: str) -> DataFrame:
    """The windows of a pane lake, each with whether the serving table has it."""
    served = sinks.read_serving(spark, current).select(
        "route_id", "window_start", F.lit(True).alias("is_current")
    )
    rows = sinks.read_panes(spark, lake).join(served, ["route_id", "window_start"], "left")
    return zoneless(rows.withColumn("is_current", F.coalesce("is_current", F.lit(False))))


def stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake and serving from one query; the rows of both, side by side."""
    folder = shared_folder(spark, "both")
    lake, current = f"{folder}/lake", f"{folder}/serving"
    sums = windows.pane_sums(clean.clean_telemetry(_telemetry(spark, sf_dir)))
    finish(sinks.run_two_sinks(sums, lake, current, f"{folder}/checkpoint", trigger=ONCE))
    return _both(spark, lake, current)


def stream_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake and serving over two checkpoints: three deliveries, then two newer ones as a new run."""
    folder = shared_folder(spark, "rerun")
    lake, current = f"{folder}/lake", f"{folder}/serving"
    rows = _zoned(views.cleaned(spark, sf_dir))
    older = F.col("ts") < F.lit(LATE_CUT).cast("timestamp")
    for name, part, n in (("a", rows.where(older), 3), ("b", rows.where(~older), 2)):
        sums = windows.pane_sums(_in_files(spark, part, n))
        finish(sinks.run_two_sinks(sums, lake, current, f"{folder}/{name}", trigger=ONCE))
    return _both(spark, lake, current)


def stream_snapshot_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot mode as the lake holds it: every window after each delivery, with its batch.

    The files are delivered in the order of their names, a third of the events each.
    """
    folder = shared_folder(spark, "snapshots")
    rows = _zoned(views.cleaned(spark, sf_dir))
    for k in range(FILES):
        rows.where(F.col("event_id") % FILES == k).write.parquet(f"{folder}/source/part={k}")
        source = files.read_table_stream(spark, f"{folder}/source/*", rows.schema)
        averages = windows.sliding_avg(source)
        finish(sinks.write_lake(averages, f"{folder}/data", f"{folder}/checkpoint", "snapshot", trigger=ONCE))
    lake = spark.read.parquet(f"{folder}/data")
    return zoneless(lake.withColumn("batch_id", F.col("batch_id").cast("bigint")).drop("run_id", "event_date"))


def stream_dated_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake that was compacted between two runs, read for all dates with the date."""
    folder = shared_folder(spark, "dated")
    rows = _zoned(views.cleaned(spark, sf_dir))
    early = F.col("ts") < F.lit(LATE_CUT).cast("timestamp")
    for name, part in (("a", rows.where(early)), ("b", rows.where(~early))):
        sums = windows.pane_sums(_in_files(spark, part))
        finish(sinks.write_lake(sums, f"{folder}/data", f"{folder}/{name}", trigger=ONCE))
        if name == "a":
            sinks.compact_lake(spark, f"{folder}/data")
    found = sinks.read_panes(spark, f"{folder}/data").withColumn("event_date", F.to_date("window_start"))
    return zoneless(found)


def stream_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two live runs with a source each and one lake: a compaction between their batches, and a restart of both."""
    folder = shared_folder(spark, "runs")
    rows = _zoned(views.cleaned(spark, sf_dir))
    for turn in range(2):
        for run in range(2):
            part = (F.col("event_id") % 2 == run) & (F.floor(F.col("event_id") / 2) % 2 == turn)
            rows.where(part).write.parquet(f"{folder}/source{run}/turn={turn}")
            source = files.read_table_stream(spark, f"{folder}/source{run}/*", rows.schema)
            finish(sinks.write_lake(windows.pane_sums(source), f"{folder}/lake", f"{folder}/run{run}", trigger=ONCE))
        if turn == 0:
            sinks.compact_lake(spark, f"{folder}/lake")
    return zoneless(sinks.read_panes(spark, f"{folder}/lake", runs="add"))


def history_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route history after two deliveries: the second refresh reads only the dates the second one touched."""
    folder = shared_folder(spark, "history")
    rows = _zoned(views.cleaned(spark, sf_dir))
    older = F.col("ts") < F.lit(LATE_CUT).cast("timestamp")
    for name, part in (("first", rows.where(older)), ("second", rows.where(~older))):
        part.write.parquet(f"{folder}/source/{name}")
        source = files.read_table_stream(spark, f"{folder}/source/*", rows.schema)
        averages = windows.sliding_avg(source)
        finish(sinks.write_lake(averages, f"{folder}/lake", f"{folder}/checkpoint", trigger=ONCE))
        refresh.refresh_history(spark, f"{folder}/lake", f"{folder}/store")
    return refresh.read_history(spark, f"{folder}/store")


# Deliveries of the late rows: by event time, and one event in seven a delivery later.
DELIVERIES = ("2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-02-15 00:00:00")
LAG, WRONG = 7, 1000


def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages and rejects of three deliveries: each event is in one of them, once.

    One event in a thousand has a clock that runs a year ahead; it must not make the others late.
    """
    folder = shared_folder(spark, "split")
    rows = _zoned(views.as_telemetry(views.table(spark, sf_dir, "events")))
    first, second, end = (F.lit(d).cast("timestamp") for d in DELIVERIES)
    due = F.when(F.col("ts") < first, 0).when(F.col("ts") < second, 1).otherwise(2)
    rows = rows.withColumn("delivery", F.least(due + F.when(F.col("event_id") % LAG == 0, 1).otherwise(0), F.lit(2)))
    rows = rows.withColumn("came", F.when(F.col("delivery") == 0, first).when(F.col("delivery") == 1, second).otherwise(end))
    rows = rows.withColumn("ts", F.when(F.col("event_id") % WRONG == 5, F.expr("ts + INTERVAL 365 DAY")).otherwise(F.col("ts")))
    for k in range(len(DELIVERIES)):
        rows.where(F.col("delivery") == k).write.parquet(f"{folder}/source/part={k}")
        source = files.read_table_stream(spark, f"{folder}/source/*", rows.schema)
        finish(
            sinks.split_late(
                source, f"{folder}/lake", f"{folder}/rejects", f"{folder}/checkpoint", LATE, ingested=F.col("came"), trigger=ONCE
            )
        )
    averages = sinks.read_panes(spark, f"{folder}/lake")
    rejects = sinks.read_rejects(spark, f"{folder}/rejects").select("event_id", "reason")
    return zoneless(averages.unionByName(rejects, allowMissingColumns=True))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the progress table says of three deliveries, over three starts of one query: rows in, good and rejected."""
    folder = shared_folder(spark, "progress")
    rows = _zoned(views.as_telemetry(views.table(spark, sf_dir, "events")))
    watch = ProgressTable(spark, f"{folder}/progress")
    good = clean.reject_reason().isNull()
    for k in range(FILES):
        rows.where(F.col("event_id") % FILES == k).write.parquet(f"{folder}/source/part={k}")
        source = files.read_table_stream(spark, f"{folder}/source/*", rows.schema)
        told = counted(source, good=F.count_if(good), rejected=F.count_if(~good))
        query = sinks.write_rejects(told, f"{folder}/rejects", f"{folder}/checkpoint", ONCE)
        finish(query)
        watch.wait(query)
    watch.close()
    table = spark.read.json(f"{folder}/progress").where("rows_in > 0")
    return table.select("batch_id", "rows_in", "good", "rejected", "late", (F.col("milliseconds") > 0).alias("timed"))


def stream_state_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current row of each route, read from the state of a stream over the lake."""
    folder = shared_folder(spark, "state")
    finish(sinks.write_lake(_windowed(spark, sf_dir), f"{folder}/lake", f"{folder}/checkpoint", trigger=ONCE))
    schema = spark.read.parquet(f"{folder}/lake").schema
    lake = files.read_table_stream(spark, f"{folder}/lake", schema)
    finish(sinks.keep_current(lake, f"{folder}/current", ONCE))
    return zoneless(sinks.read_current(spark, f"{folder}/current"))


def stream_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrival board after three batches of a stream that is joined to the dimensions as it runs."""
    folder = shared_folder(spark, "board")
    routes, baselines = dims.dim_routes(spark), dims.dim_baselines(spark)
    windowed = _windowed(spark, sf_dir)
    finish(sinks.keep_board(windowed, routes, baselines, f"{folder}/data", f"{folder}/checkpoint", ONCE))
    return sinks.read_board(spark, f"{folder}/data", routes, baselines, as_of())


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports per batch that reached the sink: the second of three deliveries holds none that is good."""
    folder = shared_folder(spark, "guard")
    rows = _zoned(views.as_telemetry(views.table(spark, sf_dir, "events")))
    good = F.col("delay_seconds").between(clean.LOWEST_DELAY, clean.HIGHEST_DELAY)
    part = F.when(good, F.col("event_id") % 2 * 2).otherwise(1)

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/data/batch_id={batch_id}")

    for k in range(FILES):
        rows.where(part == k).write.parquet(f"{folder}/source/part={k}")
        source = files.read_table_stream(spark, f"{folder}/source/*", rows.schema)
        finish(each_batch(clean.clean_telemetry(source), land, f"{folder}/checkpoint", trigger=ONCE))
    return spark.read.parquet(f"{folder}/data").groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("reports")
    )


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "raw")
    finish(
        sinks.land_raw(
            _payloads(spark, sf_dir), f"{folder}/data", f"{folder}/checkpoint", trigger=ONCE
        )
    )
    return spark.read.text(f"{folder}/data")


def text_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text files followed as a stream and copied line by line."""
    folder = shared_folder(spark, "tail")
    views.payloads(spark, sf_dir).select("payload").repartition(FILES).write.text(f"{folder}/source")
    lines = files.read_text_stream(spark, f"{folder}/source", per_trigger=1)
    finish(sinks.write_text(lines, f"{folder}/data", f"{folder}/checkpoint", ONCE))
    return spark.read.text(f"{folder}/data")


QUERIES = {
    f.__name__: f
    for f in (
        stream_sliding_delay,
        stream_upsert_delay,
        stream_panes,
        stream_quarantine,
        stream_speed_layer,
        stream_late_drop,
        stream_serving,
        stream_named_top,
        stream_two_sinks,
        stream_rerun,
        stream_snapshot_lake,
        stream_dated_lake,
        stream_two_runs,
        stream_late_split,
        stream_progress,
        stream_state_serving,
        history_refresh,
        stream_board,
        stream_empty_batch,
        raw_landing,
        text_tail,
    )
}


def prepared(fn):
    """Set the session up before a query is built."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run
