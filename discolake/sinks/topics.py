"""Publishing rows to the event topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.functions.scalars import json_text


def encode(df: DataFrame) -> DataFrame:
    """Each row as one JSON text ``value``, without a key."""
    return df.select(json_text(*[F.col(name) for name in df.columns]).alias("value"))


def topic_options(servers: str, topic: str) -> dict[str, str]:
    """Delivery is at least once: all replicas confirm, three retries."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send every row; needs the Kafka connector on the class path."""
    encode(df).write.format("kafka").options(**topic_options(servers, topic)).save()
