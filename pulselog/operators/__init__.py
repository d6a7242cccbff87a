"""Operators: events to records, roll-ups, samples, messages; text to word counts."""

from pulselog.operators.exposition import (
    exposition_text,
    prometheus_samples,
    push_requests,
    push_url,
)
from pulselog.operators.latest import (
    PUSH_GROUP,
    latest_samples,
    scrape_samples,
    value_intervals,
)
from pulselog.operators.log_counts import event_log_counts
from pulselog.operators.messages import kafka_rows
from pulselog.operators.records import (
    RECORD_NAMES,
    application_records,
    record_table,
    records,
)
from pulselog.operators.rollup import stage_rollup
from pulselog.operators.words import top_words, word_count, words

__all__ = [
    "PUSH_GROUP",
    "RECORD_NAMES",
    "application_records",
    "event_log_counts",
    "exposition_text",
    "kafka_rows",
    "latest_samples",
    "prometheus_samples",
    "push_requests",
    "push_url",
    "record_table",
    "records",
    "scrape_samples",
    "stage_rollup",
    "top_words",
    "value_intervals",
    "word_count",
    "words",
]
