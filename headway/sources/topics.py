"""Kafka topics. The connector jar comes with the cluster's ``--packages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    starting: str = "latest",
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options for one topic, or for all topics a pattern matches.

    ``min_partitions`` splits the offsets of a topic with few partitions over
    more tasks.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give a topic or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if topic is not None:
        options["subscribe"] = topic
    else:
        options["subscribePattern"] = pattern
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options
) -> DataFrame:
    """Stream of a topic's records; only new ones unless ``starting`` says else."""
    settings = topic_options(servers, topic, starting=starting, **options)
    return spark.readStream.format("kafka").options(**settings).load()


def read_topics(spark: SparkSession, servers: str, pattern: str, **options) -> DataFrame:
    """Stream of every topic whose name matches."""
    settings = topic_options(servers, pattern=pattern, **options)
    return spark.readStream.format("kafka").options(**settings).load()
