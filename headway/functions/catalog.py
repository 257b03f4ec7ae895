"""The composite expressions as functions of the session, for those who write SQL.

Each is a SQL function: the analyzer puts its body in place of the call, so a query runs
on built-in expressions alone, without Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .numbers import NUMBER_PATTERN
from .text import DIGITS_PATTERN, FULL_PATTERN

# Name and arguments, result, body; a body may call the functions above it.
FUNCTIONS = (
    ("route_code(route STRING)", "STRING", f"trim(regexp_extract(route, r'{DIGITS_PATTERN}', 1))"),
    ("full_route_code(route STRING)", "STRING", f"trim(regexp_extract(route, r'{FULL_PATTERN}', 1))"),
    ("route_label(code STRING)", "STRING", "concat('Route_', code)"),
    (
        "text_number(text STRING)",
        "DOUBLE",
        f"CASE WHEN text RLIKE r'{NUMBER_PATTERN}' THEN try_cast(trim(text) AS DOUBLE) END",
    ),
    ("minutes_of(value DOUBLE)", "DOUBLE", "CASE WHEN NOT isnan(value) AND value > 30 THEN value / 60D ELSE value END"),
    (
        "live_document(text STRING)",
        "VARIANT",
        r"""try_parse_json(regexp_replace(text, r'(?<=[:\[,])(\s*)(-?(?:NaN|Infinity))(?=\s*[,}\]])', '$1"$2"'))""",
    ),
    (
        "document_minutes(document VARIANT, text STRING)",
        "DOUBLE",
        """CASE WHEN startswith(schema_of_variant(document), 'OBJECT')
                THEN try_variant_get(document, '$.average_delay_seconds', 'double') / 60D
                ELSE minutes_of(coalesce(try_variant_get(document, '$', 'double'), text_number(text))) END""",
    ),
    ("live_minutes(text STRING, baseline DOUBLE)", "DOUBLE", "coalesce(document_minutes(live_document(text), text), baseline)"),
    ("clamp_minutes(minutes DOUBLE)", "DOUBLE", "greatest(0D, least(nanvl(minutes, 0D), 15D))"),
    ("whole_minutes(minutes DOUBLE)", "INT", "CAST(bround(minutes, 0) AS INT)"),
    (
        "next_slot(ts TIMESTAMP_NTZ, every INT)",
        "TIMESTAMP_NTZ",
        """CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)
               + make_dt_interval(0, 0, CAST((floor(minute(ts) / every) + 1) * every AS INT))""",
    ),
    (
        "minutes_until(here TIMESTAMP_NTZ, there TIMESTAMP_NTZ)",
        "INT",
        "greatest(1, CAST(timestampdiff(MINUTE, here, there) AS INT))",
    ),
    ("delay_level(minutes INT)", "STRING", "CASE WHEN minutes <= 1 THEN 'green' WHEN minutes <= 3 THEN 'yellow' ELSE 'red' END"),
    (
        "status_text(minutes INT)",
        "STRING",
        """CASE WHEN minutes <= 1 THEN 'ON TIME'
                WHEN minutes <= 3 THEN format_string('MINOR DELAY (+%d MINS)', minutes)
                ELSE format_string('HEAVY DELAY (+%d MINS)', minutes) END""",
    ),
)


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session, or replace them; returns their names."""
    for signature, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return [signature.split("(")[0] for signature, _, _ in FUNCTIONS]
