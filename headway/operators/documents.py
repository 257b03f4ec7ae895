"""Lake lines of any row family: scanned as VARIANT, typed afterwards.

A line says by its fields what it is, so one scan serves a folder that raw, windowed and
feed rows share, and fields nobody has a column for are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

DOCUMENT = "document"


def _text(field: str) -> Column:
    return F.try_variant_get(DOCUMENT, f"$.{field}", "string")


def _real(field: str) -> Column:
    return F.try_variant_get(DOCUMENT, f"$.{field}", "double")


def row_family() -> Column:
    """``feed``, ``windowed`` or ``raw`` by the fields of the document; ``other`` for an object
    (or value) with none of them, ``broken`` for a line that is no document."""

    def has(field: str) -> Column:
        return F.variant_get(DOCUMENT, f"$.{field}", "variant").isNotNull()

    return (
        F.when(F.col(DOCUMENT).isNull(), "broken")
        .when(has("entity"), "feed")
        .when(has("average_delay_seconds") | has("window_start"), "windowed")
        .when(has("delay_seconds"), "raw")
        .otherwise("other")
    )


def unknown_fields(known: tuple[str, ...] = (*schemas.LAKE.fieldNames(), "poll_ts", "entity")) -> Column:
    """The other fields of an object, by name; an empty map without any, NULL for what is no object."""
    is_object = F.schema_of_variant(DOCUMENT).startswith("OBJECT")
    members = F.when(is_object, F.col(DOCUMENT)).cast("map<string, variant>")
    return F.map_filter(members, lambda name, _: ~name.isin(*known))


def typed_rows(documents: DataFrame) -> DataFrame:
    """Lake columns of each document with its ``family`` and its ``others``. What does not fit its type is NULL.

    A column the query does not use is not taken out of the document, ``others`` included.
    """
    texts = [f.name for f in schemas.LAKE.fields if f.dataType.typeName() == "string"]
    columns = [(_text(c) if c in texts else _real(c)).alias(c) for c in schemas.LAKE.fieldNames()]
    return documents.select(row_family().alias("family"), *columns, unknown_fields().alias("others"), DOCUMENT)


def feed_rows(documents: DataFrame) -> DataFrame:
    """The feed messages among the documents, as ``feed.flatten_feed`` takes them."""
    fields = ((f.name, f.dataType.simpleString()) for f in schemas.FEED.fields)
    taken = [F.try_variant_get(DOCUMENT, f"$.{name}", kind).alias(name) for name, kind in fields]
    return documents.where(row_family() == "feed").select(*taken)
