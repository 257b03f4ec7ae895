"""A stated query set against all rows, in blocks of bounded size.

Rows are dealt into blocks by a hash of their id and the queries into blocks of
their own; a task gets one block of each. Nothing is broadcast, no task holds
more than one pair of blocks, and each pair keeps only the best k of each query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, ROW_BLOCK = 2048, 8192


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: a vector without null, NaN or infinite components."""
    v = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~odd
    )


def matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """The vectors of a column as rows; short ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    width = max(int(lengths.max(initial=0)), 1) if width is None else width
    out = np.zeros((len(column), width))
    inside = np.arange(width) < lengths[:, None]
    out[inside] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def search(
    rows: DataFrame,
    queries: DataFrame,
    best: Callable[[pa.Table, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]],
    k: int,
    score: str,
    size: int | None = None,
) -> DataFrame:
    """The k best rows of each query: (query_id, rank, vec_id, score), ties to the smaller vec_id.

    ``best(queries, rows)`` gives query ids, row ids and scores for a pair of
    blocks: at least each query's k best rows of the block. ``size`` is the
    number of rows, if known: counting them runs what made them.
    """
    queries = queries.dropDuplicates(["vec_id"])
    groups = -(-queries.count() // QUERY_BLOCK)
    parts = -(-(rows.count() if size is None else size) // ROW_BLOCK)
    if not groups:
        empty = f"query_id long, rank int, vec_id long, score {score}"
        return rows.sparkSession.createDataFrame([], empty)

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)
        return df.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(own), every)

    left = dealt(queries, "g", groups, "c", parts).groupBy("g", "c")
    right = dealt(rows, "c", parts, "g", groups).groupBy("g", "c")

    def run(some: pa.Table, block: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not some.num_rows or not block.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), kind)], names)
        q, r, s = best(some, block)
        return pa.table([pa.array(q, pa.int64()), pa.array(r, pa.int64()), pa.array(s, kind)], names)

    kind = pa.float64() if score == "double" else pa.int64()
    found = left.cogroup(right).applyInArrow(run, f"query_id long, vec_id long, score {score}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
