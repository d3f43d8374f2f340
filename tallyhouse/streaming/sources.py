"""Stream sources and sinks. Kafka needs its connector on the cluster; files serve elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.schemas import CAPTURES

MESSAGE_SCHEMA = "key string, value binary, topic string, partition int, offset long, received_at timestamp"


def kafka_messages(
    spark: SparkSession, servers: str, topics=tuple(c.topic for c in CAPTURES), max_per_trigger: int | None = None, **options
) -> DataFrame:
    """Both change topics from their beginning, committed records only."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
        .options(**options)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset",
        F.col("timestamp").alias("received_at"),
    )


def file_messages(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Messages landing as parquet files."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def write_kafka(records: DataFrame, servers: str, topic: str, headers: bool = True) -> None:
    """Publish records (key, value, headers) once each, acknowledged by all replicas."""
    writer = (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "gzip")
        .option("topic", topic)
    )
    (writer.option("includeHeaders", "true") if headers else writer).save()
