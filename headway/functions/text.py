"""Text expressions: route codes, labels and whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as the code inside a route text.
DIGITS_PATTERN = r"(\d+[a-zA-Z]?)"
FULL_PATTERN = r"([A-Z]?\d+[A-Za-z]?)"

# Fixed value: characters that count as white space around a line.
WHITE = " \t\n\r\x0b\x0c"


def route_code(route: Column, mode: str = "digits") -> Column:
    """Short code of a route text; ``''`` when it holds no digit.

    ``digits`` takes the first run of digits and one letter after it, so
    ``Route_G1`` and ``1`` share the code ``1``. ``full`` keeps the letter in
    front as well (``G1``).
    """
    patterns = {"digits": DIGITS_PATTERN, "full": FULL_PATTERN}
    return F.trim(F.regexp_extract(route, patterns[mode], 1))


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind (tabs, newlines)."""
    return F.btrim(text, F.lit(WHITE))


def split_pair(line: Column) -> tuple[Column, Column]:
    """Key and value around the first tab; the value is NULL without a tab."""
    parts = F.split(line, "\t", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def join_pair(key: Column, value: Column) -> Column:
    return F.concat(key.cast("string"), F.lit("\t"), value.cast("string"))


def route_label(code: Column) -> Column:
    return F.concat(F.lit("Route_"), code)


def vehicle_label(route: Column, suffix: Column) -> Column:
    return F.concat(F.lit("Bus-"), route, F.lit("-"), suffix)


def live_key(route: Column) -> Column:
    return F.concat(F.lit("live:Route_"), route)


def fallback_key(route: Column) -> Column:
    return F.concat(F.lit("route:"), route, F.lit(":delay"))


def quoted_numbers(json: Column) -> Column:
    """JSON text with bare NaN and Infinity in quotes, as strict readers want it."""
    return F.regexp_replace(json, r"(?<=[:\[,])(\s*)(-?(?:NaN|Infinity))(?=\s*[,}\]])", '$1"$2"')


def first_present(*texts: Column) -> Column:
    """First text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def element(values: Column, position: int) -> Column:
    """Array element by 0-based position, NULL outside the array."""
    return F.get(values, F.lit(position))


def lookup(values: Column, key: Column, default) -> Column:
    """Map value of a key, or the default."""
    return F.coalesce(F.try_element_at(values, key), F.lit(default))
