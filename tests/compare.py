"""Compare every query with its SQL: ``python tests/compare.py [sf_dir] [query ..]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(x):
    return "NaN" if isinstance(x, float) and math.isnan(x) else x


def _bag(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_cell(x) for x in row) for row in zip(*columns))


def _kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def difference(spark_table, sql_table) -> str | None:
    """First difference in columns, types or rows; None when they agree exactly."""
    ours, theirs = _kinds(spark_table), _kinds(sql_table)
    if ours != theirs:
        return f"columns {sorted(ours.items())} against {sorted(theirs.items())}"
    a, b = _bag(spark_table), _bag(sql_table)
    if a != b:
        extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"{a.total()} against {b.total()} rows; only ours {extra}; only SQL {missing}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from headway import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.build(cores="8")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            table = queries[name](spark, sf_dir).toArrow()
            took = time.time() - start
            if name in oracle:
                found = difference(table, con.execute(oracle[name]).to_arrow_table())
            else:
                found = None if table.num_rows else "no rows"
        except Exception as error:  # report and go on with the next query
            table, took, found = None, time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        rows = table.num_rows if table is not None else "-"
        note = "" if name in oracle else " (rows only)"
        print(f"{'FAIL' if found else 'ok  '} {name:24s} {rows!s:>8} rows {took:6.2f} s{note}")
        if found:
            print("     ", found)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
