"""Text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value string)``, one row per line."""
    return spark.read.text(path).select("value")
