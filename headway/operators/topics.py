"""Rows to and between topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_pair


def to_topic_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as JSON text in ``value``, without a key; NULL fields are written as ``null``."""
    names = columns or tuple(df.columns)
    return df.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))


def route_topics(
    df: DataFrame, pattern: str = ".*", alias: str = "A", separator: str = "."
) -> DataFrame:
    """Rows of the topics a pattern matches whole, under ``<alias>.<topic>``."""
    return df.where(F.col("topic").rlike(f"^(?:{pattern})$")).withColumn(
        "topic", F.concat(F.lit(alias + separator), F.col("topic"))
    )


def pair_lines(df: DataFrame, key: str = "route_id", value: str = "delay_seconds") -> DataFrame:
    """``key<TAB>value`` lines in ``value``."""
    return df.select(join_pair(F.col(key), F.col(value)).alias("value"))
