"""Files: lake, text lines, pairs, feed snapshots, and tables as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.documents import DOCUMENT
from ..operators.history import split_pairs
from ..operators.parse import parse_lake_lines


def read_lake(
    spark: SparkSession, path: str, schema: StructType | None = schemas.LAKE, fmt: str = "json"
) -> DataFrame:
    """Lake files under a folder or glob. The schema is given, which saves the
    extra pass over the files that inference takes."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_documents(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON lines of any shape as one VARIANT column; NULL for a broken line, none for a blank one."""
    reader = spark.readStream if stream else spark.read
    return reader.option("singleVariantColumn", DOCUMENT).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lake rows of JSON lines, read as text: blank and broken lines leave."""
    return parse_lake_lines(spark.read.text(path))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``route<TAB>delay`` lines as typed pairs."""
    return split_pairs(spark.read.text(path))


def read_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landed feed snapshots, one JSON message a line."""
    return (spark.readStream if stream else spark.read).schema(schemas.FEED).json(path)


def decode_feed(df: DataFrame, descriptor: str, message: str, value: str = "value") -> DataFrame:
    """Protobuf feed messages as a struct column ``feed``; needs Spark's protobuf
    module on the class path and the feed's descriptor file."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return df.withColumn("feed", from_protobuf(F.col(value), message, descFilePath=descriptor))


def read_text_stream(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """Lines of files as they arrive in a folder."""
    reader = spark.readStream
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.text(path)


def read_table_stream(
    spark: SparkSession, path: str, schema: StructType, per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder or glob as a stream, a few files at a time if asked."""
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def serving_view(spark: SparkSession, name: str) -> DataFrame:
    """The serving table registered under a name."""
    return spark.table(name)
