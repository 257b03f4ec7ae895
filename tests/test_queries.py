"""Every registered query against its SQL, exactly, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from headway.operators import monitor
from headway.plans import batch, streams, views

QUERIES = entry.queries()
ENGINE = [*batch.QUERIES, *streams.QUERIES]
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", ENGINE)
def test_query(spark, small, duck, name):
    table = QUERIES[name](spark, small).toArrow()
    assert table.num_rows > 0
    if name in ORACLE:
        assert difference(table, duck.sql(ORACLE[name]).to_arrow_table()) is None


def test_every_query_of_the_engine_has_sql():
    own = {**batch.QUERIES, **streams.QUERIES}
    assert set(own) <= set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["route_id", "avg_delay_sec", "window_start", "window_end"]
    assert df.count() == 10


def test_approximate_latency_is_close(spark, small):
    exact = {r["layer"]: r for r in QUERIES["latency_exact"](spark, small).collect()}
    for row in monitor.latency_report(views.latencies(spark, small)).collect():
        want = exact[row["layer"]]
        assert row["worst"] == want["worst"] and row["events"] == want["events"]
        for share in ("p50", "p95", "p99"):
            assert abs(row[share] - want[share]) <= 0.01 * want["worst"]
