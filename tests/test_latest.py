"""Latest values and scrapes against brute force on small data with ties and a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from pulselog import operators as ops


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    keys = ["hot"] * 4 + ["a", "b", "c", "d", "e", "f", "g", "h"]
    return [
        (random.choice(keys), random.randrange(-3000, 3000), seq, random.randrange(100))
        for seq in range(2000)
    ]


def test_latest_breaks_ties_by_sequence(spark, rows):
    frame = spark.createDataFrame(rows, "k string, ms bigint, seq bigint, v bigint").repartition(5)
    got = ops.latest_samples(frame, ("k",), time="ms", tie="seq", value="v")
    expected = {}
    for k, ms, seq, v in rows:
        expected[k] = max(expected.get(k, (-9999, -1, 0)), (ms, seq, v))
    assert {r["k"]: (r["ms"], r["seq"], r["v"]) for r in got.collect()} == expected


def test_latest_without_sequence_takes_the_largest(spark, rows):
    frame = spark.createDataFrame(rows, "k string, ms bigint, seq bigint, v bigint").repartition(5)
    got = ops.latest_samples(frame, ("k",), time="ms", tie="v", value="v")
    expected = {}
    for k, ms, _, v in rows:
        expected[k] = max(expected.get(k, (-9999, 0)), (ms, v))
    assert {r["k"]: (r["ms"], r["v"]) for r in got.collect()} == expected


@pytest.mark.parametrize("zoneless", [False, True])
def test_scrape_ticks(spark, rows, zoneless):
    frame = spark.createDataFrame(rows, "k string, ms bigint, seq bigint, v bigint")
    instant = F.timestamp_millis("ms")
    ts = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
    frame = frame.withColumn("ts", ts if zoneless else instant)
    ticks = ops.scrape_samples(frame, ("k",), "ts", "seq", "v", "500 milliseconds")
    start = F.col("tick.start")
    if zoneless:
        start = F.convert_timezone(F.lit("UTC"), F.current_timezone(), start).cast("timestamp")
    got = {
        (r["k"], r["start"]): r["v"]
        for r in ticks.select("k", F.unix_millis(start).alias("start"), "v").collect()
    }
    newest = {}
    for k, ms, seq, v in rows:
        tick = (k, ms // 500 * 500)
        newest[tick] = max(newest.get(tick, (-9999, -1, 0)), (ms, seq, v))
    assert got == {tick: v for tick, (_, _, v) in newest.items()}


def test_hot_keys_are_reduced_before_the_shuffle(spark, rows):
    frame = spark.createDataFrame(rows, "k string, ms bigint, seq bigint, v bigint")
    latest = ops.latest_samples(frame, ("k",), time="ms", tie="seq", value="v")
    words = ops.word_count(frame.select(F.col("k").alias("value")))
    for result, partial in ((latest, "partial_max_by"), (words, "partial_count")):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.index(partial) > plan.index("Exchange hashpartitioning")


def test_null_tie_is_lowest_and_rows_stay_together(spark):
    rows = [("k", 5.0, 10, None), ("k", 4.0, 9, 1), ("n", 7.0, 3, None), ("n", 8.0, None, 9)]
    samples = spark.createDataFrame(rows, "key string, value double, t bigint, seq bigint")
    got = ops.latest_samples(samples, ("key",), "t", "seq").collect()
    assert sorted(map(tuple, got)) == [("k", 5.0, 10, None), ("n", 7.0, 3, None)]


def test_tie_that_is_no_whole_number_is_refused(spark):
    samples = spark.createDataFrame([("k", 1.2, 1)], "key string, value double, t bigint")
    with pytest.raises(ValueError, match="whole number"):
        ops.latest_samples(samples, ("key",), "t")
