"""Replays in order of event times: what is read, with which delay, and the state they leave."""

import pytest
from pyspark.sql import functions as F

from pulselog import operators as ops
from pulselog import streaming
from pulselog.functions import epoch_micros
from pulselog.sources import replay

KEYS = ("user_id", "event_type")
DELAY = "1 minute"


@pytest.fixture()
def shuffled(spark, sf_dir, tmp_path):
    """The events table in four files, each with rows of all times."""
    path = str(tmp_path / "series")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", "event_type", "value", "event_id", "ts", epoch_micros(F.col("ts")).alias("micros")
    )
    events.repartition(4, "event_id").write.parquet(path)
    return spark.read.parquet(path)


def states(stream):
    done = [p for p in stream.recentProgress if p["stateOperators"]]
    return [(p["stateOperators"][0]["numRowsTotal"], p["numInputRows"]) for p in done], sum(
        p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in done
    )


def test_index_and_lateness(spark, shuffled, sf_dir):
    index = replay.time_index(shuffled, "ts")
    assert index.count() == 4
    assert index.agg(F.sum("rows")).first()[0] == shuffled.count()
    assert replay.lateness(index) > 10 * 86_400_000_000


def test_files_in_order_are_read_in_place(spark, shuffled, tmp_path):
    path = str(tmp_path / "ordered")
    index = replay.ordered_copy(shuffled, "ts", path, 5)
    assert index.count() == 5 and replay.lateness(index) == 0
    ordered = spark.read.parquet(path)
    plan = replay.plan_replay(spark, ordered, "ts", delay_micros=0, files=4)
    assert plan.path.rstrip("/").endswith("ordered") and plan.files == 5
    assert sorted(ordered.collect()) == sorted(shuffled.collect())
    other = replay.plan_replay(spark, shuffled, "ts", delay_micros=0, files=4)
    assert other.path not in shuffled.inputFiles()[0] and other.late_micros == 0


def test_ties_nulls_and_an_empty_table(spark, tmp_path):
    rows = [(k, "2024-01-01 00:00:00" if k < 50 else None) for k in range(60)]
    table = spark.createDataFrame(rows, "k int, t string").select("k", F.to_timestamp("t").alias("t"))
    index = replay.ordered_copy(table, "t", str(tmp_path / "ties"), 3)
    assert index.agg(F.sum("rows")).first()[0] == 60 and replay.lateness(index) == 0
    empty = replay.ordered_copy(table.limit(0), "t", str(tmp_path / "none"), 3)
    assert replay.lateness(empty) == 0


def test_latest_values_with_bounded_state(spark, shuffled, tmp_path):
    plan = replay.plan_replay(spark, shuffled, "ts", delay_micros=0, files=6)
    stream = replay.read_replay(spark, plan, shuffled)
    latest = streaming.recent_stream(
        stream, KEYS, "ts", "micros", "event_id", keep="1 day", delay=DELAY
    )
    table = streaming.latest_table(spark, str(tmp_path / "out"), KEYS, order="seq", fan_in=3)
    run = streaming.stream_to(latest, table, str(tmp_path / "checkpoint"))
    run.awaitTermination()
    expected = ops.latest_samples(shuffled, KEYS, "micros", "event_id").select(*KEYS, "value")
    assert sorted(table.read().select(*KEYS, "value").collect()) == sorted(expected.collect())
    rows, dropped = states(run)
    assert dropped == 0 and len(rows) >= 6
    assert max(total for total, _ in rows) < 0.5 * shuffled.count()
    assert rows[-1][0] < max(total for total, _ in rows)


def test_scrapes_with_bounded_state(spark, shuffled, tmp_path):
    plan = replay.plan_replay(spark, shuffled, "ts", delay_micros=0, files=4)
    ticks = streaming.scrape_stream(
        replay.read_replay(spark, plan, shuffled), KEYS, "ts", "event_id", "value", "15 seconds",
        delay=DELAY,
    ).select(*KEYS, F.unix_micros("tick.start").alias("start"), "value")
    keys = (*KEYS, "start")
    table = streaming.latest_table(spark, str(tmp_path / "out"), keys)
    run = streaming.stream_to(ticks, table, str(tmp_path / "checkpoint"))
    run.awaitTermination()
    expected = ops.scrape_samples(shuffled, KEYS, "ts", "event_id", every="15 seconds").select(
        *KEYS, epoch_micros(F.col("tick.start")).alias("start"), "value"
    )
    assert sorted(table.read().select(*keys, "value").collect()) == sorted(expected.collect())
    rows, dropped = states(run)
    # Each batch leaves the ticks of its last minute alone; one more batch evicts the last's.
    assert dropped == 0 and rows[-1][0] < 20
