"""Prometheus names and sample lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may not stand in a metric name / a label name.
_NOT_METRIC = "[^a-zA-Z0-9_:]"
_NOT_LABEL = "[^a-zA-Z0-9_]"


def _sanitize(name: Column, invalid: str) -> Column:
    words = F.trim(F.regexp_replace(name, invalid, " "))
    first = F.substring(words, 1, 1)
    legal_start = F.when(first.between("0", "9"), F.concat(F.lit("_"), words)).otherwise(words)
    return F.translate(legal_start, " ", "_")


def sanitize_metric_name(name: Column) -> Column:
    """Invalid characters become ``_`` (outer ones vanish); no leading digit; null stays null."""
    return _sanitize(name, _NOT_METRIC)


def sanitize_label_name(name: Column) -> Column:
    """Like :func:`sanitize_metric_name`, but a colon is invalid too."""
    return _sanitize(name, _NOT_LABEL)


def or_default(text: Column, default: str) -> Column:
    """The text, or the default where it is null or empty."""
    return F.when(F.length(text) > 0, text).otherwise(default)
