"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans in this package are written for. Joins carry no broadcast hints: a side is broadcast only when its
# measured size is under the threshold, and hot join partitions are split at run time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def cluster_settings(shuffled_bytes: int, cores: int, partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Recommended settings with shuffles cut for an amount of data: partitions that fit a task, and work for every core."""
    parts = max(2 * cores, -(-shuffled_bytes // partition_bytes))
    return {**RECOMMENDED, "spark.sql.shuffle.partitions": str(parts)}


def local_session(app: str = "stratiform", cpus: int | str = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    local = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("STRATIFORM_DRIVER_MEMORY", "8g"),
    }
    for name, value in {**RECOMMENDED, **local}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster shares; a local one only where none is named, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="stratiform-")
    return f"{base.rstrip('/')}/stratiform-{uuid.uuid4().hex}"
