"""Streams of records, of latest values and of scrapes.

All of them take a streaming DataFrame, so the source (log folder, topic, table)
is the caller's choice.  The default trigger works off what is there and stops;
pass ``trigger={"processingTime": "10 seconds"}`` to run on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from pulselog.functions.order import epoch_micros, order_key
from pulselog.operators.latest import PUSH_GROUP, latest_samples, scrape_samples
from pulselog.sinks.fanout import FanOut, Ledger, Sink

_ONCE = {"availableNow": True}


def append_records(
    records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Appends a stateless record stream to parquet, exactly once, foldered by record name."""
    writer = records.writeStream.format("parquet").outputMode("append").partitionBy("name")
    return (
        writer.option("checkpointLocation", checkpoint).trigger(**(trigger or _ONCE)).start(path)
    )


def fan_out(
    events: DataFrame, checkpoint: str, trigger: dict | None = None, **sinks: Sink
) -> tuple[StreamingQuery, FanOut]:
    """Runs every micro-batch through several sinks; failures are counted per sink.

    The checkpoint folder also holds the ledger of what each sink has had.
    """
    target = FanOut(Ledger(events.sparkSession, f"{checkpoint}/ledger"), **sinks)
    writer = events.writeStream.foreachBatch(target).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or _ONCE)).start(), target


def latest_stream(
    samples: DataFrame,
    keys: tuple[str, ...] = PUSH_GROUP,
    time: str = "epochMillis",
    tie: str = "value",
    value: str = "value",
) -> DataFrame:
    """The latest value per key, for ``update`` mode.

    State is one row per key and never ends: for a bounded set of keys. Series that come and go
    want :func:`recent_stream`, entities with an end :func:`closing.closing_stream`.
    """
    return latest_samples(samples, keys, time, tie, value)


def recent_stream(
    samples: DataFrame,
    keys: tuple[str, ...],
    at: str,
    time: str,
    tie: str,
    value: str = "value",
    keep: str = "1 day",
    *,
    delay: str,
) -> DataFrame:
    """The latest value per key and span ``keep`` of event time, for ``update`` mode.

    A span's rows leave the state when the watermark passes its end, so state holds the series of
    the open spans alone. ``seq`` orders a key's rows over spans and batches: a
    ``folders.latest_table`` of the keys ordered by it holds each key's latest value.
    """
    if isinstance(samples.schema[at].dataType, TimestampNTZType):
        samples = samples.withColumn(at, F.timestamp_micros(epoch_micros(F.col(at))))
    span = F.window(at, keep).alias("span")
    marked = samples.withWatermark(at, delay).withColumn("span", span)
    latest = latest_samples(marked, (*keys, "span"), time, tie, value)
    return latest.withColumn("seq", order_key(F.col(time), F.col(tie))).drop("span")


def scrape_stream(
    samples: DataFrame,
    keys: tuple[str, ...],
    time: str = "ts",
    tie: str = "seq",
    value: str = "value",
    every: str = "500 milliseconds",
    *,
    delay: str,
) -> DataFrame:
    """Scrapes of a stream.  Ticks older than the watermark leave the state.

    Rows that come later than ``delay`` are dropped: choose it for the source.  The query's
    progress counts them as ``numRowsDroppedByWatermark``.
    """
    if isinstance(samples.schema[time].dataType, TimestampNTZType):
        samples = samples.withColumn(time, F.timestamp_micros(epoch_micros(F.col(time))))
    return scrape_samples(samples.withWatermark(time, delay), keys, time, tie, value, every)


def upsert_log(
    updates: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the updates of a stateful stream as parquet, one folder per batch.

    A replayed batch overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = updates.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or _ONCE)).start()


def merge_latest(updates: DataFrame, keys: tuple[str, ...], value: str = "value") -> DataFrame:
    """Current rows from the folders of :func:`upsert_log`: per key that of the last batch."""
    return updates.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))
