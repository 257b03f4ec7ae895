"""Payload text to typed telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import numbers, text, times


def payload_text(df: DataFrame, value: str = "value") -> DataFrame:
    """The binary ``value`` of a topic as text column ``payload``."""
    return df.select(F.col(value).cast("string").alias("payload"))


def unwrap_envelope(payload: Column) -> Column:
    """Inner text of ``{"schema": .., "payload": ..}``, NULL if that is null; other texts stay as they are."""
    keys = F.json_object_keys(payload)
    enveloped = F.array_contains(keys, "schema") & F.array_contains(keys, "payload")
    return F.when(enveloped, F.get_json_object(payload, "$.payload")).otherwise(payload)


def json_fields(payload: Column, schema: StructType, options: dict[str, str] | None = None) -> Column:
    """The fields of a JSON object as columns; NULLs where the text is broken.

    ``inline`` over one struct makes the parse a row generator. Later filters
    stay above it, so the text is parsed once; a filter moved below a plain
    projection would repeat ``from_json`` for every field it tests.
    """
    return F.inline(F.array(F.from_json(payload, schema, options)))


def parse_telemetry(
    df: DataFrame,
    dialect: str = "tolerant",
    payload: str = "payload",
    keep: Sequence[str] = (),
) -> DataFrame:
    """JSON text to ``route_id, .., delay_seconds, ts``; broken text gives NULLs.

    ``tolerant`` reads whole and fractional epochs and date text, and delays
    written as int, real or text. ``s1`` and ``s2`` are the strict stream
    schemas: epoch seconds with whole delays, and timestamps with real delays.
    """
    if dialect == "tolerant":
        schema = schemas.TELEMETRY_TEXT
        ts = times.event_time(F.col("timestamp"))
        delay = numbers.to_whole(F.col("delay_seconds"))
    elif dialect == "s1":
        schema = schemas.TELEMETRY_EPOCH
        ts = times.from_epoch(F.col("timestamp"))
        delay = F.col("delay_seconds")
    elif dialect == "s2":
        schema = schemas.TELEMETRY_DATED
        raw = F.get_json_object(payload, "$.timestamp")
        # The reader multiplies whole numbers without a check: far ones would wrap round.
        far = raw.rlike(r"^-?\d+$") & times.from_epoch(numbers.to_double(raw)).isNull()
        df = df.withColumn("_far", far)
        ts = F.when(~F.coalesce("_far", F.lit(False)), F.col("timestamp"))
        delay = F.col("delay_seconds")
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    others = [f for f in schema.fieldNames() if f not in ("timestamp", "delay_seconds")]
    hidden = ["_far"] if dialect == "s2" else []
    return df.select(*keep, *hidden, json_fields(F.col(payload), schema)).select(
        *keep, *others, delay.alias("delay_seconds"), ts.alias("ts")
    )


def parse_lake_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON lines to ``route_id`` and the delay as text; blank lines, broken lines,
    lines with more than one document and lines that hold no object leave."""
    line = text.strip(F.col(value))
    return lines.where(is_object(line)).select(json_fields(line, schemas.LAKE_LINE))


def is_object(line: Column) -> Column:
    """Whether the whole text, without white space around it, is one JSON object.

    The JSON functions read the first document and pass over what follows. A
    text that is still JSON between brackets and as a member has nothing after it.
    """
    line = text.quoted_numbers(line)
    member = F.try_parse_json(F.concat(F.lit('{"x":'), line, F.lit("}")))
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    return F.coalesce(line.startswith("{") & member.isNotNull() & listed.isNotNull(), F.lit(False))
