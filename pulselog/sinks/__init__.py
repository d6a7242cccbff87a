"""Sinks: push gateway, Kafka, files, and several of them at once."""

from pulselog.sinks.fanout import FanOut, Ledger, Sink
from pulselog.sinks.files import write_json, write_records
from pulselog.sinks.kafka import kafka_options, write_kafka, write_kafka_stream
from pulselog.sinks.push import Delivery, deliver, http_post

__all__ = [
    "Delivery",
    "FanOut",
    "Ledger",
    "Sink",
    "deliver",
    "http_post",
    "kafka_options",
    "write_json",
    "write_kafka",
    "write_kafka_stream",
    "write_records",
]
