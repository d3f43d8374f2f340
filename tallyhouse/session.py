"""Session settings every job shares, and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Partitions are merged up to this size, small enough to be sorted in memory.
PARTITION_SIZE = "32m"
# The same for the warehouse, whose tasks hold several sorts at once.
SMALL_PARTITIONS = "16m"
# Shuffles are dealt to so many partitions at least, which Spark merges up to the size above: tasks do not grow with the input.
# Up to 200 Spark writes a file per partition, without sorting the rows.
MIN_PARTITIONS = 200

_local_folders: dict[str, str] = {}


def configure(spark: SparkSession, partition_size: str = PARTITION_SIZE) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", partition_size)
    dealt = max(MIN_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", dealt)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    application = spark.sparkContext.applicationId
    if named:
        return f"{named.rstrip('/')}/tallyhouse-{application}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_folders[application]
