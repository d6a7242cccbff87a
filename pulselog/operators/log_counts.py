"""Event census of a log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselog.functions.lines import event_name
from pulselog.schema import ALL_EVENTS


#: Stands for the event of lines that are no JSON or name no event.
UNREADABLE = "(unreadable)"


def event_log_counts(lines: DataFrame) -> DataFrame:
    """Lines per event and whether the event yields records.

    Lines that no reader turns into an event count as ``UNREADABLE``; blank lines do not count.
    """
    event = F.coalesce(event_name(F.col("value")), F.lit(UNREADABLE))
    return (
        lines.select(F.when(F.trim("value") != "", event).alias("event"))
        .where(F.col("event").isNotNull())
        .groupBy("event")
        .agg(F.count("*").alias("events"))
        .withColumn("recorded", F.col("event").isin(*ALL_EVENTS))
    )
