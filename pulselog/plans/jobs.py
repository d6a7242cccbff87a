"""The two jobs a user submits: telemetry of event logs, and the word count."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulselog import operators as ops
from pulselog import schema, sinks, streaming
from pulselog.session import tune
from pulselog.settings import Settings
from pulselog.sinks.push import Transport, http_post
from pulselog.sources import parse_events, read_event_stream, read_lines, tail_lines

log = logging.getLogger(__name__)


def telemetry(
    spark: SparkSession,
    log_dir: str,
    checkpoint: str,
    settings: Settings,
    compat: bool = False,
    trigger: dict | None = None,
    transport: Transport = http_post,
) -> tuple[StreamingQuery, sinks.FanOut]:
    """Streams a log folder to the configured sinks: push gateway, Kafka topic or both.

    ``settings.live`` follows plain files while they grow; otherwise sealed files are read.
    """
    targets: dict[str, sinks.Sink] = {}
    if settings.push_gateway:

        def push(batch: DataFrame, batch_id: int) -> sinks.Delivery:
            texts = ops.exposition_text(batch, settings.extended, compat)
            requests = ops.push_requests(
                texts, settings.push_gateway, settings.job, settings.instance
            )
            outcome = sinks.deliver(requests, transport, settings.connections)
            if outcome.failed:
                total = outcome.failed + outcome.delivered
                log.warning("batch %d: %d of %d pushes failed", batch_id, outcome.failed, total)
            return outcome

        targets["push"] = push
    if settings.kafka_broker or settings.kafka_topic:
        broker, topic = settings.require("kafka_broker"), settings.require("kafka_topic")

        def kafka(batch: DataFrame, batch_id: int) -> None:
            sinks.write_kafka(ops.kafka_rows(batch, settings.extended, compat), broker, topic)

        targets["kafka"] = kafka
    if not targets:
        raise ValueError("configure a push gateway or a Kafka broker and topic")
    kinds = schema.EXTENDED_KINDS if settings.extended else schema.BASIC_KINDS
    if settings.live:
        events = parse_events(tail_lines(tune(spark), log_dir), kinds)
    else:
        events = read_event_stream(tune(spark), log_dir, kinds, settings.max_files)
    return streaming.fan_out(events, checkpoint, trigger, **targets)


def count_words(spark: SparkSession, source: str, target: str, files: int | None = None) -> None:
    """Counts the words of text files and writes them as JSON, most frequent first."""
    sinks.write_json(ops.word_count(read_lines(spark, source)), target, files)
