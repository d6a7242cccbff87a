"""Kafka messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulselog.operators.catalogue import Record
from pulselog.operators.records import as_json, as_struct, each_record


def kafka_rows(events: DataFrame, extended: bool = False, compat: bool = False) -> DataFrame:
    """One message per record: no key, the record's map as indented UTF-8 JSON."""

    def render(record: Record) -> str:
        value = f"CAST({as_json(record, pretty=True)} AS binary)"
        return as_struct({"key": "CAST(NULL AS binary)", "value": value})

    return each_record(events, render, extended, compat)
