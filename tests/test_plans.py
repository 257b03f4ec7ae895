"""Shapes the physical plans must keep."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from headway.operators import serving
from headway.plans import batch, views
from headway.sources import dims


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", batch.QUERIES)
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", r"SortAggregate\(key=\[\w"):
        assert not re.search(bad, text), bad


def test_averages_combine_before_each_shuffle(spark, small):
    for query in (batch.sliding_delay, batch.historical_avg, batch.polls_count, batch.ingest_rate):
        assert "partial_" in plan(query(spark, small))


def test_latest_rows_use_hash_aggregates(spark, small):
    for query in (batch.latest_snapshot, batch.serving_current, batch.serving_from_panes):
        text = plan(query(spark, small))
        assert "partial_max_by" in text and "SortAggregate" not in text


def test_only_needed_columns_are_read(spark, small):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(batch.sliding_delay(spark, small)))
    assert scans and all({c.split(":")[0] for c in s.split(",")} == {"ts", "user_id", "value"} for s in scans)


def test_filters_reach_the_scan(spark, small):
    df = views.table(spark, small, "events").where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    assert "GreaterThanOrEqual(ts" in plan(batch.views.as_telemetry(df))


def test_dates_prune_the_table(spark, small, tmp_path):
    from headway.streaming import sinks

    sinks.write_table(views.telemetry(spark, small), str(tmp_path), "ts")
    day = spark.read.parquet(str(tmp_path)).where("event_date = date'2024-01-05'")
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan(day))
    assert 0 < day.count() < 100


def test_top_needs_no_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(batch.top_delays(spark, small))


def test_feed_needs_no_shuffle(spark, small):
    assert "Exchange" not in plan(batch.feed_flatten(spark, small))


def test_unknown_routes_leave_before_the_shuffle(spark, small):
    text = plan(serving.known_routes(views.cleaned(spark, small), dims.dim_routes(spark)))
    assert "LeftSemi, BuildRight" in text and "hashpartitioning" not in text


def test_merging_history_and_live_adds_no_shuffle(spark, small):
    lake, live = views.lake(spark, small), views.current(spark, small)
    sides = sum(plan(d).count("Exchange hash") for d in (batch.history.route_history(lake), live))
    both = plan(serving.lambda_view(batch.history.route_history(lake), live))
    assert both.count("Exchange hash") == sides


def test_ordered_windows_never_see_raw_rows(spark, small):
    """Each Window works on aggregated rows."""
    for query in (batch.retain_recent, batch.latency_exact):
        lines = plan(query(spark, small)).splitlines()
        for i, line in enumerate(lines):
            if re.search(r"\bWindow \[", line):
                depth = re.search(r"\bWindow \[", line).start()
                below = [x for x in lines[i + 1 : i + 12] if len(x) > depth]
                assert any("HashAggregate" in x for x in below)
