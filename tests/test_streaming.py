"""Streams over several micro-batches against the batch result."""

import pytest
from pyspark.sql import functions as F
from samplelog import LINES

from pulselog import operators as ops
from pulselog import schema, streaming
from pulselog.functions import epoch_micros
from pulselog.sources import read_event_stream, read_events


@pytest.fixture()
def log(tmp_path):
    """A rolling log in five sealed files."""
    folder = tmp_path / "logs" / "eventlog_v2_app-9"
    folder.mkdir(parents=True)
    for part in range(5):
        text = "\n".join(LINES[part::5]) + "\n"
        (folder / f"events_{part}_app-9").write_text(text, encoding="utf-8")
    return str(folder.parent)


def test_record_stream_equals_batch(spark, log, tmp_path):
    events = read_event_stream(spark, log, schema.EXTENDED_KINDS, max_files_per_trigger=1)
    out = str(tmp_path / "out")
    stream = streaming.append_records(
        ops.records(events, extended=True), out, str(tmp_path / "checkpoint")
    )
    stream.awaitTermination()
    assert sum(progress["numInputRows"] > 0 for progress in stream.recentProgress) == 5
    columns = ["metricType", "name", "appId", "epochMillis", "payload"]
    batch = ops.records(read_events(spark, log, schema.EXTENDED_KINDS), extended=True)
    got = spark.read.parquet(out).select(columns)
    assert sorted(got.collect()) == sorted(batch.select(columns).collect())


def test_fan_out_stream(spark, log, tmp_path):
    counted = []

    def texts(batch, batch_id):
        counted.append(ops.exposition_text(batch).count())

    def broken(batch, batch_id):
        raise RuntimeError("gateway down")

    events = read_event_stream(spark, log, schema.BASIC_KINDS, max_files_per_trigger=2)
    stream, fan = streaming.fan_out(
        events, str(tmp_path / "checkpoint"), texts=texts, broken=broken
    )
    stream.awaitTermination()
    assert stream.exception() is None
    expected = ops.exposition_text(read_events(spark, log, schema.BASIC_KINDS)).count()
    assert sum(counted) == expected
    assert (fan.delivered["texts"], fan.failed["broken"]) == (3, 3)


@pytest.fixture()
def series(spark, sf_dir, tmp_path):
    """The events table in files of any order, and a stream over them, one file per batch."""
    path = str(tmp_path / "series")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", "event_type", "value", "event_id", "ts", epoch_micros(F.col("ts")).alias("micros")
    )
    events.repartition(4, "event_id").write.parquet(path)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return spark.read.parquet(path), source.parquet(path)


KEYS = ("user_id", "event_type")


def test_latest_stream_equals_batch(spark, series, tmp_path):
    batch, stream = series
    out = str(tmp_path / "out")
    latest = streaming.latest_stream(stream, KEYS, "micros", "event_id")
    streaming.upsert_log(latest, out, str(tmp_path / "checkpoint")).awaitTermination()
    merged = streaming.merge_latest(spark.read.parquet(out), KEYS)
    expected = ops.latest_samples(batch, KEYS, "micros", "event_id").select(*KEYS, "value")
    assert spark.read.parquet(out).select("batch").distinct().count() == 4
    assert sorted(merged.collect()) == sorted(expected.collect())


def test_scrape_stream_equals_batch(spark, series, tmp_path):
    batch, stream = series
    out = str(tmp_path / "out")
    # The files arrive in any order, hence the long delay.
    ticks = streaming.scrape_stream(
        stream, KEYS, "ts", "event_id", every="15 seconds", delay="400 days"
    ).select(*KEYS, F.unix_micros("tick.start").alias("start"), "value")
    streaming.upsert_log(ticks, out, str(tmp_path / "checkpoint")).awaitTermination()
    merged = streaming.merge_latest(spark.read.parquet(out), (*KEYS, "start"))
    expected = ops.scrape_samples(batch, KEYS, "ts", "event_id", every="15 seconds").select(
        *KEYS, epoch_micros(F.col("tick.start")).alias("start"), "value"
    )
    assert sorted(merged.collect()) == sorted(expected.collect())
