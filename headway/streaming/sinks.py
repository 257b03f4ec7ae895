"""Sinks of streams and tables.

Everything is written by the executors; nothing is collected. A batch writes a
folder named by its run and id in overwrite mode, so a batch that runs twice
leaves one result. A run is the stream of one checkpoint: its number is claimed
beside the data under the identity Spark gave that stream, so a new checkpoint
goes on behind the old one instead of over it. A batch counts once it is in the
commit log of its table, from which readers take the folders.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.board import arrival_board, lines_to_merge, live_lines, newest_lines
from ..operators.clean import clean_telemetry, reject_reason, rejected_telemetry
from ..operators.history import latest, snapshot_order
from ..operators.serving import latest_from_panes, latest_per_route
from ..operators.topics import pair_lines, to_topic_rows
from ..operators.windows import SIZE, SLIDE, TOP, pane_end, pane_sums, roll_panes, seconds, top_delays
from .commits import CommitLog, Live, remove, there
from .runner import ONCE, Trigger, each_batch, every, writer

_DATE = re.compile(r"/event_date=([^/]+)/")
LAKE_MODES = {"snapshot": "complete", "upsert": "update", "final": "append"}


# ---- runs ---------------------------------------------------------------


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream a checkpoint belongs to: the same after restarts, new with a new checkpoint."""
    text = spark.read.text(f"{checkpoint}/metadata")
    return text.select(F.get_json_object("value", "$.id").alias("id")).first()["id"]


def run_number(spark: SparkSession, path: str, identity: str) -> int:
    """The number of a run in the order of the runs that wrote below ``path``; claimed on first use.

    The claims are a small table, a row per run. Of two runs that claim one
    number at the same time, the smaller identity has it and the other claims anew.
    """
    claims = f"{path}/_runs"
    while True:
        known = there(lambda: spark.read.schema("run_id long, stream string").json(claims))
        rows = known.collect() if known is not None else []
        owner: dict[int, str] = {}
        for row in rows:
            owner[row["run_id"]] = min(owner.get(row["run_id"], row["stream"]), row["stream"])
        mine = [n for n, stream in owner.items() if stream == identity]
        if mine:
            return min(mine)
        claim = spark.range(1).select(F.lit(max(owner, default=-1) + 1).alias("run_id"), F.lit(identity).alias("stream"))
        claim.coalesce(1).write.mode("append").json(claims)


class _Run:
    """The run of one sink; its number is looked up with the first batch."""

    def __init__(self, path: str, checkpoint: str) -> None:
        self.path, self.checkpoint, self._number = path, checkpoint, None
        self.served: str | None = None  # the version this process published last

    def number(self, spark: SparkSession) -> int:
        if self._number is None:
            self._number = run_number(spark, self.path, stream_identity(spark, self.checkpoint))
        return self._number


# ---- lake ---------------------------------------------------------------


def _place(run_id: int, batch_id: int) -> str:
    return f"run_id={run_id}/batch_id={batch_id}"


def batch_folder(path: str, run_id: int, batch_id: int) -> str:
    return f"{path}/{_place(run_id, batch_id)}"


def write_batch(batch: DataFrame, folder: str, fmt: str = "parquet") -> DataFrame | None:
    """Rows by date into a folder, a file per date; returns them as written, None (and no folder) without any."""
    if "event_date" not in batch.columns:
        batch = batch.withColumn("event_date", F.to_date("pane" if "pane" in batch.columns else "window_start"))
    dated = batch.hint("rebalance", "event_date")
    out = dated.write.mode("overwrite").format(fmt).option("ignoreNullFields", "false")
    out.partitionBy("event_date").save(folder)
    spark = batch.sparkSession
    landed = spark.read.format(fmt).schema(dated.schema).load(folder)
    if not landed.inputFiles():  # names only: no date, no file
        remove(spark, folder)
        return None
    return landed


def commit_batch(
    batch: DataFrame, path: str, run_id: int, batch_id: int, fmt: str = "parquet"
) -> DataFrame | None:
    """``write_batch`` below a lake, then the entry in its log, with the dates the batch holds."""
    landed = write_batch(batch, batch_folder(path, run_id, batch_id), fmt)
    dates = set() if landed is None else {d for f in landed.inputFiles() for d in _DATE.findall(f)}
    place = None if landed is None else _place(run_id, batch_id)
    CommitLog(batch.sparkSession, path).add(run_id, batch_id, place, sorted(dates))
    return landed


def write_lake(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "upsert",
    fmt: str = "parquet",
    trigger: Trigger = None,
) -> StreamingQuery:
    """Windowed averages (or pane sums) of each batch to the lake, by run, batch and ``event_date``.

    ``snapshot`` writes every window again after each batch. ``upsert`` writes
    only the windows the batch changed; ``read_snapshots`` keeps the last one.
    ``final`` writes a window once, when the watermark has passed its end.
    """
    run = _Run(path, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, path, run.number(batch.sparkSession), batch_id, fmt)

    return each_batch(df, land, checkpoint, LAKE_MODES[mode], trigger, skip_empty=False)


def committed(spark: SparkSession, path: str, live: Live) -> DataFrame:
    """All rows of a lake with their run and batch: the compacted table and the batches committed since.

    A folder that no log belongs to is read as it lies.
    """
    batches = spark.read.option("basePath", path)
    if live.empty:
        return batches.parquet(path)
    parts = [batches.parquet(*(f"{path}/{f}" for f in live.folders))] if live.folders else []
    parts += [spark.read.parquet(f"{path}/{live.base}")] if live.base else []
    if not parts:
        return batches.parquet(path)  # nothing but empty batches
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("run_id", "batch_id")})


def _kind(rows: DataFrame) -> tuple[str, tuple[str, ...]]:
    """The start and the values of a lake's rows."""
    if "added_sum" in rows.columns:
        return "pane", ("added_sum", "added_count")
    if "pane" in rows.columns:
        return "pane", ("delay_sum", "delay_count")
    return "window_start", ("window_end", "average_delay_seconds")


def _last_written(spark: SparkSession, path: str, live: Live | None = None) -> DataFrame:
    """The last row of each date, route and start, of whichever run; a filter on ``event_date`` prunes the files."""
    rows = committed(spark, path, live or CommitLog(spark, path).live())
    start, values = _kind(rows)
    if "added_sum" in values:  # each batch holds what it adds
        sums = [F.sum(c).alias(c.replace("added", "delay")) for c in values]
        return rows.groupBy("event_date", "route_id", start).agg(*sums)
    return latest(rows, ("event_date", "route_id", start), values, snapshot_order())


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Last value of every route and window a lake holds; a filter on ``event_date`` prunes the files."""
    return _last_written(spark, path)


def added_panes(spark: SparkSession, path: str) -> DataFrame:
    """Pane sums of a lake whose runs hold different rows: the last value of each run, added up."""
    rows = committed(spark, path, CommitLog(spark, path).live())
    own = latest(rows, ("event_date", "run_id", "route_id", "pane"), ("delay_sum", "delay_count"), F.col("batch_id"))
    sums = [F.sum(c).alias(c) for c in ("delay_sum", "delay_count")]
    return own.groupBy("event_date", "route_id", "pane").agg(*sums)


def read_panes(
    spark: SparkSession, path: str, size: str = SIZE, slide: str = SLIDE, runs: str = "replace"
) -> DataFrame:
    """Sliding averages of a lake that holds pane sums.

    A stream of ``pane_sums`` keeps and writes one row per route and minute
    where a stream of ``sliding_avg`` has five. A lake may have several live runs.
    ``runs`` says what they are to each other: "replace" if a later run reads the
    same source anew, "add" if each run has a source of its own.
    """
    panes = added_panes(spark, path) if runs == "add" else _last_written(spark, path)
    return roll_panes(panes, size, slide)


def write_rejects(
    df: DataFrame, path: str, checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """Quarantine of parsed rows no average takes up, in a folder per reason."""
    out = writer(rejected_telemetry(df), checkpoint, "append", trigger)
    return out.format("parquet").partitionBy("reason").start(path)


def split_late(
    df: DataFrame,
    lake: str,
    rejects: str,
    checkpoint: str,
    late: str = "10 minutes",
    slide: str = SLIDE,
    ingested: Column | None = None,
    trigger: Trigger = None,
) -> StreamingQuery:
    """Parsed rows to averages or to quarantine: each row is in one of the two, once.

    A watermark drops late rows without a word. Here the low-water mark is the newest event
    time of the good rows so far less ``late``; it is kept with each batch in the log of the
    rejects. Rows whose pane ended by the mark of the batches before go to the rejects with
    the reason "late", beside those that cleaning turns away. The others are added up per
    route and pane, and the lake takes each batch's sums as something to add. So there is no
    state to keep, and a batch that runs again overwrites what it wrote. With ``ingested``,
    rows whose clock runs ahead are rejected before they can move the mark.
    """
    runs = _Run(rejects, checkpoint), _Run(lake, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held, number = (r.number(spark) for r in runs)
        before = CommitLog(spark, rejects).mark(held, batch_id)
        is_late = F.unix_micros(pane_end(slide)) <= F.lit(before)
        marked = batch.withColumn("reason", F.coalesce(reject_reason(ingested=ingested), F.when(is_late, "late")))
        seen = Observation()
        newest = F.max(F.when(F.col("reason").isNull(), F.unix_micros("ts"))).alias("newest")
        refused = marked.observe(seen, newest).where("reason IS NOT NULL")
        refused.write.mode("overwrite").partitionBy("reason").parquet(batch_folder(rejects, held, batch_id))
        sums = pane_sums(clean_telemetry(marked.where("reason IS NULL")), slide)
        sums = sums.withColumnsRenamed({"delay_sum": "added_sum", "delay_count": "added_count"})
        commit_batch(sums, lake, number, batch_id)
        marks = [before] if before is not None else []
        if seen.get["newest"] is not None:
            marks.append(seen.get["newest"] - seconds(late) * 1_000_000)
        # Last, so that a batch that runs again finds the mark it had before.
        CommitLog(spark, rejects).add(held, batch_id, _place(held, batch_id), mark=max(marks, default=None))

    return each_batch(df, land, checkpoint, "append", trigger, skip_empty=False)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of ``split_late``: the rows of the committed batches, with the reason."""
    folders = CommitLog(spark, path).live().folders
    return spark.read.option("basePath", path).parquet(*(f"{path}/{f}" for f in folders))


def write_table(df: DataFrame, path: str, ts: str) -> None:
    """Parquet by ``event_date``.

    The rebalance hint gathers each date into files of even size; adaptive
    execution splits a date that holds much more than the others.
    """
    (
        df.withColumn("event_date", F.to_date(ts))
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .partitionBy("event_date")
        .parquet(path)
    )


def compact_lake(spark: SparkSession, path: str, out: str | None = None) -> bool:
    """Rewrite the batches of a lake as one table by date.

    Without ``out`` the table becomes part of the lake by one entry of the log. It keeps each
    run's last rows apart, and the entry names for each run the last batch it holds: batches
    that land meanwhile, of any run, are read beside it. Of two compactions at the same time
    one is committed; False says that this one was not, and nothing is lost by that.
    """
    log = CommitLog(spark, path)
    live = log.live()
    rows = committed(spark, path, live)
    start, values = _kind(rows)
    if out is not None:
        write_table(_last_written(spark, path, live), out, start)
        return True
    if "added_sum" in values:
        own = rows.groupBy("run_id", "route_id", start).agg(*[F.sum(c).alias(c) for c in values], F.max("batch_id").alias("batch_id"))
    else:
        own = latest(rows, ("run_id", "route_id", start), (*values, "batch_id"), F.col("batch_id"))
    base = f"_compacted/{uuid.uuid4().hex}"
    write_table(own, f"{path}/{base}", start)
    covers = live.reached
    if live.empty:  # a lake from before it had a log
        covers = {r[0]: r[1] for r in rows.groupBy("run_id").agg(F.max("batch_id")).collect()}
    return log.cover(live, base, covers)


# ---- text ---------------------------------------------------------------


def write_text(
    df: DataFrame, path: str, checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """A stream's single text column to files, each row exactly once."""
    return writer(df, checkpoint, "append", trigger).format("text").start(path)


def land_raw(
    df: DataFrame, path: str, checkpoint: str, payload: str = "payload", trigger: Trigger = None
) -> StreamingQuery:
    """Payload text, unchanged, to the raw part of the lake."""
    return write_text(df.select(payload), path, checkpoint, trigger)


def write_pairs(df: DataFrame, path: str, **columns: str) -> None:
    """``route<TAB>delay`` lines of a table."""
    pair_lines(df, **columns).write.mode("overwrite").text(path)


# ---- topics -------------------------------------------------------------


def sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return options


def write_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """Rows of a stream as keyless JSON records of a topic."""
    out = writer(to_topic_rows(df), checkpoint, "append", trigger)
    return out.format("kafka").options(**sink_options(servers, topic)).start()


def write_topics(
    df: DataFrame, servers: str, checkpoint: str, trigger: Trigger = None
) -> StreamingQuery:
    """``topic, value`` rows, each to the topic it names."""
    out = writer(df.select("topic", "value"), checkpoint, "append", trigger)
    return out.format("kafka").options(**sink_options(servers)).start()


# ---- serving ------------------------------------------------------------


def _published(spark: SparkSession, path: str) -> list[tuple[int, int, object]]:
    """(run, batch, time) of the complete versions, oldest first: a version is in the log once its rows are written."""
    return [(run, batch, at) for run, batch, _, _, at in CommitLog(spark, path).live().batches]


def _publish(
    df: DataFrame, path: str, run_id: int, batch_id: int, keep_for: str | None = None
) -> None:
    """Write a version and commit it; then drop the versions replaced longer than ``keep_for`` ago.

    The newest version, and with it the one just written, is never dropped, and
    without ``keep_for`` none is: how long a reader may hold on to a version is
    the caller's to know.
    """
    spark, log = df.sparkSession, CommitLog(df.sparkSession, path)
    df.write.mode("overwrite").parquet(batch_folder(path, run_id, batch_id))
    log.add(run_id, batch_id, _place(run_id, batch_id))
    if keep_for is not None:
        live = log.live()
        limit = spark.range(1).select((F.current_timestamp() - F.expr(f"INTERVAL {keep_for}")).alias("t")).first()["t"]
        gone = [v[:2] for v, (*_, replaced) in zip(live.batches, live.batches[1:]) if replaced < limit]
        gone = [v for v in gone if v < (run_id, batch_id)]
        if gone and log.cover(live, None, live.covers | dict(gone)):  # first: no reader looks for them any more
            for version in gone:
                remove(spark, batch_folder(path, *version))


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """Newest complete version of a serving table: of the newest run, its newest batch."""
    return spark.read.parquet(f"{path}/{CommitLog(spark, path).live().folders[-1]}")


def _with_previous(
    current: DataFrame, path: str, run: _Run, run_id: int, batch_id: int, newest: Callable[..., DataFrame] = latest_per_route
) -> DataFrame:
    """The rows over those of the version before, whichever run wrote it.

    The log is read with a process's first batch; after that the version before is its own last one.
    """
    spark = current.sparkSession
    if run.served is None:
        older = [b[2] for b in CommitLog(spark, path).live().batches if b[:2] < (run_id, batch_id)]
        run.served = older[-1] if older else None
    if run.served is None or run.served == _place(run_id, batch_id):
        return current
    previous = spark.read.parquet(f"{path}/{run.served}")
    both = previous.withColumn("fresh", F.lit(0)).unionByName(current.withColumn("fresh", F.lit(1)))
    return newest(both, "fresh")


def _serve(rows: DataFrame, path: str, run: _Run, batch_id: int, keep_for: str | None) -> None:
    number = run.number(rows.sparkSession)
    _publish(_with_previous(_current(rows), path, run, number, batch_id), path, number, batch_id, keep_for)
    run.served = _place(number, batch_id)


def _current(rows: DataFrame, size: str = SIZE) -> DataFrame:
    """The newest row of each route, from windows or from pane sums."""
    rows = latest_from_panes(rows, size) if "pane" in rows.columns else latest_per_route(rows)
    return rows.select("route_id", "window_start", "window_end", "average_delay_seconds")


def upsert_serving(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = None,
    keep_for: str | None = None,
) -> StreamingQuery:
    """One current row per route: the batch's changed windows (or panes) over the last version.

    A version is a small table (a row per route) in a folder of its own, so
    readers never meet a half-written one. ``keep_for`` ("1 hour") drops versions
    so long after they were replaced.
    """
    run = _Run(path, checkpoint)

    def publish(batch: DataFrame, batch_id: int) -> None:
        _serve(batch, path, run, batch_id, keep_for)

    return each_batch(df, publish, checkpoint, "update", trigger, skip_empty=False)


def keep_board(
    windowed: DataFrame,
    routes: DataFrame,
    baselines: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = None,
    keep_for: str | None = None,
) -> StreamingQuery:
    """The live lines of the arrival board: changed windows, joined to the dimensions inside the running query.

    Each batch publishes a version of at most one line per route; ``read_board`` shows all routes as of the last one.
    """
    run = _Run(path, checkpoint)

    def publish(batch: DataFrame, batch_id: int) -> None:
        number = run.number(batch.sparkSession)
        lines = newest_lines(batch.withColumn("fresh", F.lit(1)), "fresh")
        _publish(_with_previous(lines, path, run, number, batch_id, newest_lines), path, number, batch_id, keep_for)
        run.served = _place(number, batch_id)

    return each_batch(live_lines(windowed, routes, baselines), publish, checkpoint, "update", trigger, skip_empty=False)


def read_board(spark: SparkSession, path: str, routes: DataFrame, baselines: DataFrame, as_of: Column) -> DataFrame:
    """The arrival board of every route, live where ``keep_board`` has a line."""
    merged = lines_to_merge(read_serving(spark, path), routes, baselines)
    return arrival_board(merged, as_of)


CURRENT = ("window_start", "window_end", "average_delay_seconds")


def keep_current(lake: DataFrame, checkpoint: str, trigger: Trigger = None) -> StreamingQuery:
    """The current row of each route as the state of a stream over a lake's windows.

    The state store is the table: nothing is written beside the checkpoint, and
    ``read_current`` reads it as of the last batch. A window that is read again changes nothing.
    """
    newest = F.max(F.struct("window_end", "run_id", "batch_id", *(c for c in CURRENT if c != "window_end")))
    out = writer(lake.groupBy("route_id").agg(newest.alias("newest")), checkpoint, "update", trigger)
    return out.format("noop").start()


def read_current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows ``keep_current`` holds, straight from its state store."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.route_id", *(f"value.max.{c}" for c in CURRENT))


def run_serving(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = "10 seconds",
    keep_for: str | None = None,
) -> StreamingQuery:
    """Refresh the serving table at a fixed interval."""
    return upsert_serving(df, path, checkpoint, every(interval), keep_for)


def serve_named(
    df: DataFrame, name: str, path: str, checkpoint: str, trigger: Trigger = None, compact_every: int = 100
) -> StreamingQuery:
    """The whole aggregate as a table that SQL can query under ``name``.

    Each batch lands the windows it changed; the name stands for the last value
    of every window, read from the compacted table and the batches since (fewer
    than ``compact_every``). Rows stay in files, and with a watermark the state is bounded.
    """
    spark = df.sparkSession
    run = _Run(path, checkpoint)

    def publish(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, path, run.number(batch.sparkSession), batch_id)
        if batch_id % compact_every == compact_every - 1:
            compact_lake(spark, path)
        live = CommitLog(spark, path).live()
        if live.folders or live.base:
            _last_written(spark, path, live).drop("event_date").createOrReplaceTempView(name)

    return each_batch(df, publish, checkpoint, "update", trigger, skip_empty=False)


def run_two_sinks(
    df: DataFrame,
    lake: str,
    serving: str,
    checkpoint: str,
    trigger: Trigger = None,
    keep_for: str | None = None,
) -> StreamingQuery:
    """Lake and serving table from one query: one read, one state, one checkpoint.

    Give it pane sums with a watermark: one state row per route and minute, and
    bounded state. Sliding averages without one reproduce the unbounded form.
    The serving rows come from the lake files just written, so the batch is
    computed once and needs no cache that a lost executor would empty.
    """
    runs = _Run(lake, checkpoint), _Run(serving, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        landed = commit_batch(batch, lake, runs[0].number(batch.sparkSession), batch_id)
        if landed is not None:
            _serve(landed, serving, runs[1], batch_id, keep_for)

    return each_batch(df, land, checkpoint, "update", trigger, skip_empty=False)


# ---- display ------------------------------------------------------------


def show_top(spark: SparkSession, name: str, n: int = TOP) -> None:
    """Print the largest delays of a serving table."""
    top_delays(spark.table(name), n).show(n, truncate=False)


def show_rows(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def show_stream(df: DataFrame, checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """Print the first rows of each batch."""
    return each_batch(df, lambda batch, _: show_rows(batch), checkpoint, "append", trigger)
