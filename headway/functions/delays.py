"""Delay expressions: feed presence rule, live values and status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import minutes_of, to_double
from .text import quoted_numbers


def stop_delay(departure: Column, arrival: Column) -> Column:
    """Delay of a stop update: the departure's if one is present, else the
    arrival's, else 0. Presence decides, so a departure without an inner
    delay gives 0 and never falls through to the arrival."""
    return (
        F.when(departure.isNotNull(), F.coalesce(departure["delay"], F.lit(0)))
        .when(arrival.isNotNull(), F.coalesce(arrival["delay"], F.lit(0)))
        .otherwise(F.lit(0))
    )


def live_minutes(text: Column, baseline: Column) -> Column:
    """Delay in minutes from the stored text of a route, not yet clamped.

    An object carries seconds in ``average_delay_seconds``; a bare number, or
    a number in quotes, follows ``minutes_of``; anything else is the baseline.
    """
    document = F.try_parse_json(quoted_numbers(text))
    is_object = F.schema_of_variant(document).startswith("OBJECT")
    in_object = F.try_variant_get(document, "$.average_delay_seconds", "double") / 60.0
    in_scalar = F.try_variant_get(document, "$", "double")
    return F.coalesce(
        F.when(is_object, in_object).otherwise(
            minutes_of(F.coalesce(in_scalar, to_double(text)))
        ),
        baseline,
    )


def delay_level(minutes: Column) -> Column:
    return F.when(minutes <= 1, "green").when(minutes <= 3, "yellow").otherwise("red")


def status_text(minutes: Column) -> Column:
    return (
        F.when(minutes <= 1, F.lit("ON TIME"))
        .when(minutes <= 3, F.format_string("MINOR DELAY (+%d MINS)", minutes))
        .otherwise(F.format_string("HEAVY DELAY (+%d MINS)", minutes))
    )
