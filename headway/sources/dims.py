"""Dimensions: routes, baselines, paths and the vehicles shown on them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .. import schemas

# The route codes of the network.
ROUTES = [
    "G1", "G2", "C1", "C2", "C3", "C4", "C5", "C6", "H1", "H2", "H3", "N4", "N6", "1", "4", "7", "7A",
    "7B", "7D", "9", "11", "13", "14", "15", "15A", "15B", "15D", "16", "16D", "26", "27", "27A", "27B",
    "27X", "32", "32X", "33", "33A", "33X", "37", "38", "38A", "38B", "38D", "39", "39A", "39X", "40",
    "40B", "40D", "41", "41B", "41C", "41D", "41X", "42", "42X", "43", "44", "44B", "46A", "46E", "47",
    "49", "53", "54A", "56A", "61", "65", "65B", "68", "68A", "69", "69X", "70", "70X", "77A", "77X",
    "79", "79A", "83", "83A", "84", "84A", "84X", "99", "120", "122", "123", "130", "140", "142", "145",
    "150", "151", "155", "P29", "X25", "X26", "X27", "X28", "X30", "X31", "X32",
]

# Usual delay in minutes; every other route has the default.
BASELINES = {
    "46A": 4.0,
    "39A": 5.0,
    "G1": 2.0,
    "G2": 2.0,
    "16": 3.0,
    "140": 2.5,
    "C1": 4.0,
    "C2": 3.0,
    "15": 4.5,
    "13": 3.5,
    "44": 5.0,
}
DEFAULT_BASELINE = 3.0

# Route lines as [longitude, latitude]; every other route has the default.
PATHS = {
    "G1": [[-6.345, 53.340], [-6.315, 53.342], [-6.280, 53.344], [-6.260, 53.349], [-6.240, 53.348]],
    "C1": [[-6.380, 53.355], [-6.320, 53.350], [-6.260, 53.348], [-6.230, 53.345], [-6.180, 53.340]],
}
DEFAULT_PATH = [[-6.300, 53.345], [-6.270, 53.348], [-6.250, 53.346], [-6.220, 53.342]]

# Path position, label suffix, speed and status of the vehicles shown.
VEHICLES = [
    (1, "101", "22 km/h", "On Schedule"),
    (2, "102", "14 km/h", "Minor Traffic"),
    (3, "103", "0 km/h (At Stop)", "At Bus Stop"),
]


def _local(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """A short list as a relation whose size the planner knows, so joins need no hint."""
    columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), schema.fields)]
    return spark.createDataFrame(pa.table(columns, schema.names), schema)


def dim_routes(spark: SparkSession) -> DataFrame:
    """``pos`` (from 1) and ``route``."""
    return _local(spark, list(enumerate(ROUTES, 1)), schemas.ROUTE)


def dim_baselines(spark: SparkSession) -> DataFrame:
    return _local(spark, list(BASELINES.items()), schemas.BASELINE)


def dim_paths(spark: SparkSession) -> DataFrame:
    return _local(spark, list(PATHS.items()), schemas.PATH)


def dim_vehicles(spark: SparkSession) -> DataFrame:
    return _local(spark, VEHICLES, schemas.VEHICLE)
