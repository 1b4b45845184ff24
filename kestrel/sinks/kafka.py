"""Kafka sink for encoded messages (needs the spark-sql-kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a ``value`` (and optional ``key``) column to ``topic``.

    Pair with ``files.encode_delimited`` / ``files.encode_json_array`` to
    produce the delimiter-joined or JSON-array payloads of the original feeders.
    """
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def kafka_writer(servers: str, topic: str):
    """``foreachBatch`` body publishing each micro-batch (at-least-once)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_kafka(batch, servers, topic)
    return write
