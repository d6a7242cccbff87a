"""State that ends with its entities."""

from pyspark.sql import functions as F

from pulselog import operators as ops
from pulselog import streaming

SCHEMA = "job string, instance string, appid string, type string, metric string, value bigint, epochMillis bigint"
MINUTE = 60_000


def run(spark, tmp_path, batches, name="one", **options):
    """Feeds the batches one by one and returns the final table and the state rows after each."""
    folder = tmp_path / f"in-{name}"
    folder.mkdir()
    samples = spark.readStream.schema(SCHEMA).parquet(str(folder)).select(
        "*",
        F.timestamp_millis("epochMillis").alias("at"),
        streaming.push_entity(F.col("type")).alias("entity"),
    )
    latest = streaming.closing_stream(
        samples, F.col("at"), streaming.push_ended(F.col("type")), delay="1 second", **options
    )
    table = streaming.latest_table(spark, str(tmp_path / f"out-{name}"), ops.PUSH_GROUP, fan_in=3)
    totals = []
    for batch in batches:
        rows = [("j", "i", "a", *row) for row in batch]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        stream = streaming.stream_to(latest, table, str(tmp_path / f"checkpoint-{name}"))
        stream.awaitTermination()
        totals.append(stream.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    return table, totals



def test_names(spark):
    rows = [("stageEnd-3-0",), ("stageSubmitted-3-0",), ("jobStart-7",), ("taskMetrics-1-2",)]
    got = spark.createDataFrame(rows, "type string").select(
        streaming.push_entity(F.col("type")), streaming.push_ended(F.col("type"))
    )
    assert [tuple(r) for r in got.collect()] == [
        ("stage-3-0", True), ("stage-3-0", False), ("job-7", False), ("task-1-2", True)
    ]


def test_state_rises_and_falls(spark, tmp_path):
    """Jobs that run over several batches, ten each; after their end only the open ones stay."""
    batches = []
    for k in range(6):
        start = (k + 1) * 10 * MINUTE
        rows = [(f"jobStart-{10 * k + j}", "starttime", start + j, start + j) for j in range(10)]
        if k:
            rows += [
                (f"jobEnd-{10 * (k - 1) + j}", "completiontime", start + j, start + j)
                for j in range(9)
            ]
        batches.append(rows)
    batches.append([("jobStart-999", "starttime", 1, 200 * MINUTE)])
    table, totals = run(spark, tmp_path, batches)
    everything = spark.createDataFrame([("j", "i", "a", *r) for b in batches for r in b], SCHEMA)
    want = ops.latest_samples(everything)
    assert sorted(table.read().select(want.columns).collect()) == sorted(want.collect())
    # Of each batch's ten jobs nine end in the next one; the tenth and the last ten never do.
    assert totals[-1] == 5 + 10 + 1 and max(totals) <= 5 + 10 + 9 + 9
    closed = {(r.type, r.closed) for r in table.read().collect()}
    assert ("jobStart-0", True) in closed and ("jobEnd-0", True) in closed
    assert ("jobStart-9", False) in closed and ("jobStart-999", False) in closed


def test_idle_entities_go_and_come_back(spark, tmp_path):
    day = 24 * 60 * MINUTE
    batches = [
        [("jobStart-1", "starttime", 5, day), ("executorAdded-x", "time", 1, day)],
        [("jobStart-2", "starttime", 6, 3 * day)],
        [("jobStart-1", "starttime", 7, 4 * day), ("jobStart-3", "starttime", 8, 9 * day)],
        [("jobEnd-3", "completiontime", 9, 9 * day + 5)],
    ]
    table, totals = run(spark, tmp_path, batches, idle="1 day")
    got = {r.type: (r.value, r.closed) for r in table.read().collect()}
    assert got["executorAdded-x"] == (1, True) and got["jobStart-1"] == (7, True)
    assert got["jobStart-3"] == (8, False) or got["jobStart-3"] == (8, True)
    assert totals[1] == 1 and totals[-1] <= 2


def test_order_within_and_over_batches(spark, tmp_path):
    """Newest by (time, value); a time of zero counts; rows without a time don't."""
    batches = [
        [("jobStart-1", "m", 5, 0), ("jobStart-1", "m", 9, 0), ("jobStart-1", "n", 2, None)],
        [("jobStart-1", "m", 3, 1000), ("jobStart-1", "m", 4, 1000), ("jobStart-1", "k", 1, 1000)],
        [("jobStart-1", "m", 8, 1000)],
    ]
    table, _ = run(spark, tmp_path, batches)
    got = {r.metric: (r.value, r.epochMillis) for r in table.read().collect()}
    assert got == {"m": (8, 1000), "k": (1, 1000)}


def test_buckets_of_entities_give_the_same(spark, tmp_path):
    """Many entities share a call of Python; each still ends by itself."""
    batches = []
    for k in range(2):
        start = (k + 1) * 10 * MINUTE
        rows = [(f"jobStart-{30 * k + j}", "starttime", start + j, start + j) for j in range(30)]
        rows += [(f"jobEnd-{30 * (k - 1) + j}", "m", j, start + j) for j in range(29) if k]
        batches.append(rows)
    batches.append([("jobStart-999", "starttime", 1, 200 * MINUTE)])
    batches.append([("jobStart-0", "starttime", 7, 201 * MINUTE)])
    one, _ = run(spark, tmp_path, batches)
    two, totals = run(spark, tmp_path, batches, name="two", buckets=3)
    columns = [*ops.PUSH_GROUP, "value", "epochMillis", "tie_value", "closed"]
    assert sorted(one.read().select(columns).collect()) == sorted(two.read().select(columns).collect())
    assert max(totals) <= 3


def test_rows_go_in_and_out_as_columns():
    """A group's rows are plain columns; only what is kept is one text."""
    import json

    import pandas as pd

    from pulselog.streaming import closing

    class State:
        exists, hasTimedOut, text = False, False, None

        @property
        def get(self):
            return (self.text,)

        def getCurrentWatermarkMs(self):
            return self.now

        def update(self, kept):
            self.exists, self.text = True, kept[0]

        def remove(self):
            self.exists = False

        def setTimeoutTimestamp(self, at):
            self.due = at

    state = State()
    state.now = 0
    keep = closing._keeper(linger=10, idle=1000)
    rows = [("a", "m", 5, 1, "x", False, 5), ("a", "m", 5, 2, None, False, 5), ("a", "m", 4, 9, "z", False, 4)]
    rows += [("b", "m", 7, closing._NO_TIE, "y", True, 7), ("b", "n", 7, 1, "1.5", False, 6)]
    (out,) = keep(("k",), iter([pd.DataFrame(rows[:2], columns=closing._ROW), pd.DataFrame(rows[2:], columns=closing._ROW)]), state)
    assert [tuple(r) for r in out.itertuples(index=False)] == [
        ("a", False, "m", 5, 2, None), ("b", False, "m", 7, closing._NO_TIE, "y"), ("b", False, "n", 7, 1, "1.5")
    ]
    assert sorted(json.loads(state.text)) == ["a", "b"] and state.due == 17
    state.now, state.hasTimedOut = 17, True
    (out,) = keep(("k",), iter([]), state)
    assert out["_entity"].tolist() == ["b", "b"] and out["closed"].all()
    assert sorted(json.loads(state.text)) == ["a"] and state.due == 1005
