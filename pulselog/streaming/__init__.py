"""Structured Streaming forms of the operators."""

from pulselog.streaming.closing import closing_stream, push_ended, push_entity
from pulselog.streaming.folders import FolderTable, latest_table, records_table, stream_to
from pulselog.streaming.runs import (
    append_records,
    fan_out,
    latest_stream,
    merge_latest,
    recent_stream,
    scrape_stream,
    upsert_log,
)

__all__ = [
    "FolderTable",
    "append_records",
    "closing_stream",
    "fan_out",
    "latest_stream",
    "latest_table",
    "merge_latest",
    "push_ended",
    "push_entity",
    "recent_stream",
    "records_table",
    "scrape_stream",
    "stream_to",
    "upsert_log",
]
