"""From raw documents to packed training sequences: four stages, each a table that the next one reads.

1. ``quality``: documents that the classifier rejects go.
2. ``line_dedup``: later copies of repeated line runs are deleted; a document of which nothing is left goes.
3. ``near_dup``: one document of each class of near-duplicates stays.
4. ``pack``: what is left is packed into sequences.

The first three return the columns of ``documents``. ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import common, jaccard, line_dedup, packing, quality
from headway.session import shared_folder

TOKENIZER = "word_bpe_49k.json"
#: A character that is no white space for ``str.split``, by which near_dup takes words.
SOLID = r"[^\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs; emptied documents go, documents empty before stay."""
    lines, gone = "_pipeline_lines", "_pipeline_gone"
    out = line_dedup.dedup_lines(docs, counts=(lines, gone))
    out = out.where((F.col(gone) == 0) | F.col("text").rlike(SOLID))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, length).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def keep_one_of_a_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", keep_one_of_a_class),
    ("pack", pack_sequences),
]

#: A trained classifier, MinHash and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again."""
    common.ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
