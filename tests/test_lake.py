"""The commit log, two live runs, refreshed history, late rows, progress and state."""

import os

import pytest
from pyspark.sql import functions as F

from headway.operators import history, monitor, serving, windows
from headway.plans import views
from headway.sources import files
from headway.streaming import commits, refresh, runner, sinks
from headway.streaming.commits import CommitLog
from headway.streaming.runner import ONCE

COLUMNS = ("route_id", "window_start", "window_end", "average_delay_seconds")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def cleaned(spark, small):
    return views.cleaned(spark, small).withColumn("ts", F.col("ts").cast("timestamp"))


def panes(spark, *values):
    """Pane sums: (route, minute, sum, count)."""
    df = spark.createDataFrame([(r, f"2024-01-0{d} 10:00:00", s, n) for r, d, s, n in values], "route_id string, t string, delay_sum long, delay_count long")
    return df.select("route_id", F.col("t").cast("timestamp").alias("pane"), "delay_sum", "delay_count")


def averages(spark, folder, **options):
    found = sinks.read_panes(spark, folder, "1 minute", **options)
    return {r.route_id: r.average_delay_seconds for r in found.collect()}


# ---- log ------------------------------------------------------------------


def test_batches_of_all_runs_are_found_after_a_compaction(spark, folder):
    sinks.commit_batch(panes(spark, ("0", 1, 10, 1)), folder, 0, 0)
    sinks.commit_batch(panes(spark, ("1", 1, 11, 1)), folder, 1, 0)
    assert sinks.compact_lake(spark, folder)
    sinks.commit_batch(panes(spark, ("2", 1, 12, 1)), folder, 0, 1)
    sinks.commit_batch(panes(spark, ("3", 1, 13, 1)), folder, 1, 1)
    assert averages(spark, folder) == {"0": 10, "1": 11, "2": 12, "3": 13}
    assert sinks.compact_lake(spark, folder)
    assert CommitLog(spark, folder).live().batches == []
    assert averages(spark, folder) == {"0": 10, "1": 11, "2": 12, "3": 13}


def test_runs_replace_or_add(spark, folder):
    """Both runs write a route and pane; the first then writes its sum anew."""
    sinks.commit_batch(panes(spark, ("7", 1, 10, 1)), folder, 0, 0)
    sinks.commit_batch(panes(spark, ("7", 1, 50, 1)), folder, 1, 0)
    assert averages(spark, folder) == {"7": 50}
    assert averages(spark, folder, runs="add") == {"7": 30}
    sinks.compact_lake(spark, folder)
    assert averages(spark, folder, runs="add") == {"7": 30}
    sinks.commit_batch(panes(spark, ("7", 1, 30, 2)), folder, 0, 1)
    assert averages(spark, folder, runs="add") == {"7": pytest.approx(80 / 3)}
    sinks.compact_lake(spark, folder)
    assert averages(spark, folder, runs="add") == {"7": pytest.approx(80 / 3)}
    assert averages(spark, folder) == {"7": 50}


def test_only_committed_batches_are_read_and_a_retry_counts_once(spark, folder):
    sinks.commit_batch(panes(spark, ("7", 1, 10, 1)), folder, 0, 0)
    sinks.write_batch(panes(spark, ("8", 1, 10, 1)), sinks.batch_folder(folder, 0, 1))  # ended before its commit
    assert averages(spark, folder) == {"7": 10}
    sinks.commit_batch(panes(spark, ("8", 1, 20, 1)), folder, 0, 1)
    sinks.commit_batch(panes(spark, ("8", 1, 20, 1)), folder, 0, 1)
    assert averages(spark, folder) == {"7": 10, "8": 20}
    assert [b[:2] for b in CommitLog(spark, folder).live().batches] == [(0, 0), (0, 1)]
    sinks.commit_batch(panes(spark).limit(0), folder, 0, 2)
    assert averages(spark, folder) == {"7": 10, "8": 20}


def test_of_two_compactions_one_is_committed(spark, folder):
    log = CommitLog(spark, folder)
    log.add(0, 0, "a")
    before = log.live()
    log.add(0, 1, "b")
    assert log.cover(log.live(), "second", {0: 1})
    assert not log.cover(before, "first", before.reached)  # began earlier, came later
    assert log.live().base == "second" and log.live().batches == []


def test_the_log_stays_short(spark, folder, monkeypatch):
    monkeypatch.setattr(commits, "EPOCH", 4)
    log = CommitLog(spark, folder)
    for batch in range(27):
        log.add(3, batch, None if batch % 5 == 2 else f"f{batch}", [f"2024-01-{batch + 1:02d}"], mark=batch)
        if batch == 13:
            assert log.cover(log.live(), "table", {3: 9})
        if batch == 20:
            log.add(3, 20, "f20", ["2024-01-21"], mark=20)  # the batch that folds runs again
    live = log.live()
    assert [b[1] for b in live.batches] == list(range(10, 27)) and live.base == "table"
    assert live.folders == [f"f{b}" for b in range(10, 27) if b % 5 != 2]
    assert log.mark(3, 20) == 19 and log.mark(3, 0) is None
    listed = [f for _, _, names in os.walk(f"{folder}/_commits") for f in names if f.endswith(".json")]
    assert len(listed) <= 2 * 4 + 3


def test_an_empty_log_is_empty(spark, folder):
    live = CommitLog(spark, folder).live()
    assert live.empty and live.folders == [] and live.reached == {}


# ---- history --------------------------------------------------------------


def land(spark, folder, df, name):
    df.write.parquet(f"{folder}/source/{name}")
    source = files.read_table_stream(spark, f"{folder}/source/*", df.schema)
    runner.finish(sinks.write_lake(windows.sliding_avg(source), f"{folder}/lake", f"{folder}/cp", trigger=ONCE))


def test_a_refresh_reads_the_dates_that_changed(spark, cleaned, folder):
    lake, store = f"{folder}/lake", f"{folder}/store"
    early = F.col("ts") < F.lit("2024-01-10").cast("timestamp")
    land(spark, folder, cleaned.where(early & (F.col("event_id") % 9 != 0)), "a")
    assert refresh.refresh_history(spark, lake, store) is None  # the first one reads all
    third = F.to_date("ts") == F.lit("2024-01-03")
    land(spark, folder, cleaned.where(third & (F.col("event_id") % 9 == 0)), "b")
    dates = refresh.changed_dates(spark, lake, store)
    assert "2024-01-03" in dates and set(dates) <= {"2024-01-02", "2024-01-03"}
    plan = sinks.read_snapshots(spark, lake).where(F.col("event_date").isin(dates))._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert refresh.refresh_history(spark, lake, store) == dates
    seen = cleaned.where((early & (F.col("event_id") % 9 != 0)) | third)
    assert rows(refresh.read_history(spark, store)) == rows(history.route_history(windows.sliding_avg(seen)))
    assert refresh.refresh_history(spark, lake, store) == []  # nothing new: nothing read
    # A compaction of batches the store has is no reason to read all; one of others is.
    sinks.compact_lake(spark, lake)
    assert refresh.changed_dates(spark, lake, store) == []
    land(spark, folder, cleaned.where(~early), "c")
    sinks.compact_lake(spark, lake)
    assert refresh.refresh_history(spark, lake, store) is None
    seen = cleaned.where((early & (F.col("event_id") % 9 != 0)) | third | ~early)
    assert rows(refresh.read_history(spark, store)) == rows(history.route_history(windows.sliding_avg(seen)))


def test_history_keeps_the_null_route_and_null_delays(spark, folder):
    df = spark.createDataFrame(
        [(None, "2024-01-01", 1.0), ("7", "2024-01-01", None), ("8", "2024-01-01", None), ("8", "2024-01-02", 3.0)],
        "route_id string, d string, average_delay_seconds double",
    )
    df = df.select("route_id", F.col("d").cast("timestamp").alias("window_start"), F.col("d").cast("timestamp").alias("window_end"), "average_delay_seconds")
    sinks.commit_batch(df, f"{folder}/lake", 0, 0)
    refresh.refresh_history(spark, f"{folder}/lake", f"{folder}/store")
    assert rows(refresh.read_history(spark, f"{folder}/store")) == rows(history.route_history(df))


# ---- late rows ------------------------------------------------------------


def test_each_row_is_averaged_or_rejected_once(spark, folder):
    deliveries = [
        [(1, "7", 60, "2024-01-01 10:00:30"), (2, "7", 9999, "2024-01-01 10:00:40"), (3, "7", 5, "2030-01-01 00:00:00"), (4, "7", 5, None)],
        [(5, "7", 60, "2024-01-01 12:00:00"), (6, "7", 60, "2024-01-01 09:40:00"), (7, "7", 60, "2024-01-01 09:50:10")],
        [(8, "7", 60, "2024-01-01 11:00:00"), (9, "", 60, "2024-01-01 12:00:10"), (10, None, None, None)],
        [],
    ]
    kinds = "event_id long, route_id string, delay_seconds int, t string"
    for k, part in enumerate(deliveries):
        df = spark.createDataFrame(part, kinds).withColumn("ts", F.col("t").cast("timestamp")).drop("t")
        df = df.withColumn("came", F.lit("2024-01-01 13:00:00").cast("timestamp"))
        df.write.parquet(f"{folder}/in/part={k}")
        source = files.read_table_stream(spark, f"{folder}/in/*", df.schema)
        query = sinks.split_late(source, f"{folder}/lake", f"{folder}/r", f"{folder}/cp", ingested=F.col("came"), trigger=ONCE)
        runner.finish(query)
    rejects = {r.event_id: r.reason for r in sinks.read_rejects(spark, f"{folder}/r").collect()}
    assert rejects == {
        2: "delay out of range", 3: "event time ahead", 4: "no event time", 6: "late",
        8: "late", 9: "no route code", 10: "unparsed",
    }
    counts = sinks._last_written(spark, f"{folder}/lake").agg(F.sum("delay_count").alias("n")).first().n
    assert counts == 3  # events 1, 5 and 7: the mark was 9:50:30, and the pane of 7 ended behind it
    sinks.compact_lake(spark, f"{folder}/lake")
    assert sinks._last_written(spark, f"{folder}/lake").agg(F.sum("delay_count").alias("n")).first().n == 3


def test_a_wrong_clock_is_kept_from_the_watermark(spark, cleaned, folder):
    df = cleaned.withColumn("came", F.lit("2024-02-01").cast("timestamp"))
    wrong = df.limit(1).withColumn("ts", F.lit("2099-01-01").cast("timestamp"))
    both = df.unionByName(wrong)
    want = rows(windows.sliding_avg(df).select(*COLUMNS))
    assert rows(windows.sliding_avg(both, ingested=F.col("came")).select(*COLUMNS)) == want
    both.write.parquet(f"{folder}/in")
    source = files.read_table_stream(spark, f"{folder}/in", both.schema, per_trigger=1)
    for lake, made in (("w", windows.sliding_avg(source, late="365 days", ingested=F.col("came"))), ("p", windows.pane_sums(source, late="365 days", ingested=F.col("came")))):
        runner.finish(sinks.write_lake(made, f"{folder}/{lake}", f"{folder}/cp-{lake}", trigger=ONCE))
    assert rows(sinks.read_snapshots(spark, f"{folder}/w").select(*COLUMNS)) == want
    assert rows(sinks.read_panes(spark, f"{folder}/p").select(*COLUMNS)) == want


# ---- progress, state, sketches -------------------------------------------


def test_progress_is_kept_over_restarts(spark, cleaned, folder):
    watch = runner.ProgressTable(spark, f"{folder}/progress")
    for k in range(3):
        cleaned.where(F.col("event_id") % 3 == k).write.parquet(f"{folder}/in/part={k}")
        source = files.read_table_stream(spark, f"{folder}/in/*", cleaned.schema)
        told = runner.counted(source, early=F.count_if(F.col("delay_seconds") < 0), longest=F.max("delay_seconds"))
        query = sinks.write_lake(windows.pane_sums(told, late="1 hour"), f"{folder}/lake", f"{folder}/cp", trigger=ONCE)
        runner.finish(query)
        watch.wait(query)
    watch.close()
    table = spark.read.json(f"{folder}/progress").where("rows_in > 0")
    got = {r.batch_id: (r.rows_in, r.early, r.longest) for r in table.collect()}
    for k, batch in enumerate(sorted(got)):
        part = cleaned.where(F.col("event_id") % 3 == k)
        assert got[batch] == tuple(part.agg(F.count(F.lit(1)), F.count_if(F.col("delay_seconds") < 0), F.max("delay_seconds")).first())
    assert table.select("query").distinct().count() == 1 and table.select("run").distinct().count() == 3
    assert table.agg(F.sum("late").alias("n")).first().n > 0  # panes of the later parts that the watermark had closed


def test_state_holds_the_current_row_of_each_route(spark, cleaned, folder):
    cut = F.lit("2024-01-15").cast("timestamp")
    for name, part in (("a", cleaned.where(F.col("ts") < cut)), ("b", cleaned.where(F.col("ts") >= cut))):
        land(spark, folder, part, name)
        schema = spark.read.parquet(f"{folder}/lake").schema
        runner.finish(sinks.keep_current(files.read_table_stream(spark, f"{folder}/lake", schema), f"{folder}/current", ONCE))
    want = serving.latest_per_route(windows.sliding_avg(cleaned))
    got = sinks.read_current(spark, f"{folder}/current").select(*want.columns)
    assert rows(got) == rows(want)
    assert rows(got.where("route_id = '7'")) == rows(want.where("route_id = '7'"))


def test_sketches_merge_to_the_figures_of_all_rows(spark, small):
    df = views.latencies(spark, small)
    parts = [monitor.latency_sketches(df.where(F.col("latency_seconds") % 3 == k)) for k in range(3)]
    store = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = monitor.latency_from_sketches(store)
    exact = monitor.latency_exact(df)
    assert rows(merged.select("layer", "worst", "events")) == rows(exact.select("layer", "worst", "events"))
    slack = F.col("events") * monitor.SKETCH_SLACK + 1
    assert monitor.within_rank(merged, df, slack).where("NOT within").count() == 0
    wrong = merged.withColumn("p50", F.col("p95"))
    assert monitor.within_rank(wrong, df, slack).where("NOT within").count() == 2
