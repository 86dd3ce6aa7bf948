"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings the operators are designed for. AQE coalesces small shuffle partitions and splits skewed ones, also
# where that costs one more exchange; the html and text columns are wide, so Arrow batches stay short.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

BRIEF_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ADVISED_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "crawlweave", cores: str | int = "*", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A local session with the library defaults; on a cluster pass the same settings to spark-submit."""
    builder = SparkSession.builder.appName(app).master(os.environ.get("SPARK_MASTER", f"local[{cores}]"))
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Put the library defaults on a session somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def brief_shuffles(spark: SparkSession, partition_size: str = "") -> Iterator[None]:
    """Shuffle files of what runs inside go when it has run, not when the driver's memory is collected.

    For jobs that run each plan once: a plan that runs again would shuffle again. A stream started inside keeps the
    settings. With ``partition_size`` partitions reach that size also where it leaves cores idle.
    """
    settings = {BRIEF_SHUFFLES: "true"}
    if partition_size:
        settings |= {PARALLELISM_FIRST: "false", ADVISED_SIZE: partition_size}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="crawlweave-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only where a local session names none (single machine, tests) it is a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
