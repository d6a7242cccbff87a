"""Validity intervals against the ticks they stand for."""

import datetime

import pytest
from pyspark.sql import functions as F

from pulselog import operators as ops

SCHEMA = "k string, ts timestamp, seq bigint, value double"
START = datetime.datetime(2024, 5, 1, 23, 59, 50)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def intervals(spark, rows, **options):
    table = spark.createDataFrame([(k, at(s), n, v) for n, (k, s, v) in enumerate(rows)], SCHEMA)
    seen = ops.value_intervals(table, ("k",), every="1 second", **options)
    seconds = lambda t: None if t is None else round((t - START).total_seconds())
    return sorted(
        ((r.k, r.value, seconds(r.first_tick), seconds(r.last_tick)) for r in seen.collect()), key=str
    )


@pytest.mark.parametrize("span", [10**6, 7 * 10**6, 86_400 * 10**6])
def test_one_row_a_change(spark, span):
    """Repeats make no row, whether they lie in one span or in several."""
    rows = [
        ("a", 0.2, 1.0), ("a", 0.7, 2.0), ("a", 3.5, 2.0), ("a", 11.0, 2.0), ("a", 20.4, 3.0),
        ("a", 40.0, 2.0), ("b", 5.0, None), ("b", 6.0, None), ("b", 30.0, 1.0), ("b", 31.5, None),
        (None, 1.0, 4.0), (None, 90.0, 4.0),
    ]
    assert intervals(spark, rows, span_micros=span) == sorted(
        [
            ("a", 2.0, 1, 20), ("a", 3.0, 21, 40), ("a", 2.0, 41, None),
            ("b", None, 6, 30), ("b", 1.0, 31, 31), ("b", None, 32, None), (None, 4.0, 2, None),
        ],
        key=str,
    )


def test_intervals_say_what_every_tick_sees(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("user_id < 40")
    keys = ("event_type",)
    seen = ops.value_intervals(events, keys, "ts", "event_id", every="1 hour", span_micros=10**11)
    ticks = ops.scrape_samples(events, keys, "ts", "event_id", every="1 hour")
    both = ticks.join(seen.withColumnRenamed("value", "held"), "event_type").where(
        (F.col("tick.end") >= F.col("first_tick"))
        & (F.col("last_tick").isNull() | (F.col("tick.end") <= F.col("last_tick")))
    )
    assert both.count() == ticks.count()
    assert both.where("NOT held <=> value").count() == 0


def test_empty(spark):
    assert intervals(spark, []) == []
