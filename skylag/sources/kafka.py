"""Kafka topics as streaming or batch DataFrames. Needs the Spark Kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSETS = ("earliest", "latest")


def source_options(
    servers: str,
    topics: list[str] | tuple[str, ...],
    starting: str = "earliest",
    max_per_trigger: int = 0,
) -> dict[str, str]:
    """Options of a reader over one or more topics.

    `starting` counts only without a checkpoint: after that, the checkpoint remembers the
    offsets, as a consumer group does. `max_per_trigger` 0 means no limit.
    """
    if starting not in OFFSETS:
        raise ValueError(f"starting must be one of {', '.join(OFFSETS)}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topics(spark: SparkSession, servers: str, topics, **kwargs) -> DataFrame:
    """Messages with key and value as text, and their topic."""
    options = source_options(servers, topics, **kwargs)
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select(
            F.col("key").cast("string").alias("key"), "value", "topic",
            F.col("timestamp").alias("message_time"),
        )
    )


def write_topics(messages: DataFrame, servers: str, checkpoint: str, **trigger):
    """Start a stream that sends (key, value, topic) rows; the topic may differ per row."""
    return (
        messages.select("key", "value", "topic")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def write_batch(messages: DataFrame, servers: str) -> None:
    messages.select("key", "value", "topic").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).save()
