"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build(app: str = "headway", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the results depend on: one zone, and state that can spill to disk.

    ``events.ts`` is zone-less; casting it for a stream and back must use UTC.
    RocksDB keeps the (route, window) state off the JVM heap and uploads only
    what changed in a batch; without a row count, a put needs no get. Java does
    not compile methods beyond 8,000 bytes of code; a stage that large would be
    interpreted, so its operators run one by one, in methods cut to size.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rocksdb = "spark.sql.streaming.stateStore.rocksdb"
    spark.conf.set(f"{rocksdb}.changelogCheckpointing.enabled", "true")
    spark.conf.set(f"{rocksdb}.trackTotalNumberOfRows", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/headway"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared root; the same rule for every master."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
