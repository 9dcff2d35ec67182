"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings for tables of about 100 TB on some 1000 executors. The initial number
# of shuffle partitions is about twice their cores; adaptive execution joins the
# small ones. Raise it for a load that shuffles the whole fact table.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_session(app: str, **conf: str) -> SparkSession:
    """Session of a submitted job; master and ``spark.checkpoint.dir`` come from the cluster."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**CLUSTER_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster passes its own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when their query ends.

    Else they stay until the driver happens to collect its garbage, which on a job
    of many writes means to its end. Frames that are run twice inside shuffle twice.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerline-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. A folder of one
    machine (``file:``) will do in local mode only; where the setting is missing
    there, a temporary folder of this process takes its place.
    """
    local = spark.conf.get("spark.master", "").startswith("local")
    root = spark.conf.get("spark.checkpoint.dir", None) or (_local_folder() if local else None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not local and root.startswith("file:"):
        raise ValueError(f"spark.checkpoint.dir names a folder of one machine: {root}")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
