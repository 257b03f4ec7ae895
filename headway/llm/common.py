"""Shared helpers: scratch tables, Arrow batches, white-space chunks, tokenizer files."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Bytes of text in one Arrow batch, so that a batch of very long texts stays small.
BATCH_BYTES = 4 << 20
#: Entries of a per-task cache; a full cache is emptied, so memory is bounded for any vocabulary.
CACHE_ENTRIES = 600_000

_CONTROL = re.compile("[\x1c-\x1f]")  # white space for str.split, but not for the tokenizers
_WHITE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")

_WIDE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes as well as rows, and send this package to the workers once.

    The package goes the way of ``--py-files``: a zip that Spark copies to each executor.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        made = Path(tempfile.mkdtemp(prefix="code-"), f"{package.name}.zip")
        atexit.register(shutil.rmtree, made.parent, ignore_errors=True)
        with zipfile.ZipFile(made, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(made))
        _shipped.add(context.applicationId)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only (key, text): other columns, whatever their names, play no part. NULL text is empty."""
    return df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def squeezed(raw: bytes) -> bytes:
    """Bytes compressed, behind their length: Spark's own codec for shuffles has no entropy coding."""
    raw = memoryview(raw)
    return raw.nbytes.to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], Iterable], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one batch to one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def vocabulary(spark: SparkSession, path: str):
    """The bytes of a tokenizer file (a few MB by nature), sent to each executor once."""
    if os.path.getsize(path) > 64 << 20:
        raise ValueError(f"{path} is too large for a tokenizer file")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def plain_spaces(text: str) -> str:
    """The text with a space for each white-space character beyond ASCII."""
    return text if text.isascii() else _WIDE.sub(" ", text)


def chunks(text: str) -> list[str]:
    """The text's parts between white space (Unicode White_Space, as the tokenizers define it)."""
    if _CONTROL.search(text):
        return [x for x in _WHITE.split(text) if x]
    return text.split()
