"""Streaming scans of the event topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC = "track_events"


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """The topic from its start; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def read_message_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Files with one JSON message per line, as a stream of ``value``."""
    return spark.readStream.options(**options).text(path)
