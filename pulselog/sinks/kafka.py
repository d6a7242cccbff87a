"""Kafka delivery through Spark's connector (a package of its own at submit time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Producer settings.
PRODUCER = {
    "kafka.retries": "10",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "0",
    "kafka.buffer.memory": "16384000",
}


def kafka_options(broker: str, topic: str, client_id: str = "pulselog") -> dict[str, str]:
    if not broker:
        raise ValueError("a Kafka broker is required")
    if not topic:
        raise ValueError("a Kafka topic is required")
    return {
        "kafka.bootstrap.servers": broker,
        "topic": topic,
        "kafka.client.id": client_id,
        **PRODUCER,
    }


def write_kafka(rows: DataFrame, broker: str, topic: str, client_id: str = "pulselog") -> None:
    """Writes ``(key, value)`` rows to a topic."""
    options = kafka_options(broker, topic, client_id)
    rows.write.format("kafka").options(**options).save()


def write_kafka_stream(
    rows: DataFrame, broker: str, topic: str, checkpoint: str, client_id: str = "pulselog"
) -> StreamingQuery:
    """The same for a streaming DataFrame."""
    options = kafka_options(broker, topic, client_id)
    writer = rows.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
