"""A log that Spark itself wrote: what is read must match what ran."""

import subprocess
import sys
from pathlib import Path

import pytest

from pulselog import operators as ops
from pulselog.sources import read_events, read_lines

JOB = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", "file://" + sys.argv[1])
    .config("spark.sql.shuffle.partitions", "3").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
try:
    spark.range(10).select(F.assert_true(F.col("id") < 5)).collect()
except Exception:
    pass
spark.stop()
"""


@pytest.fixture(scope="module")
def log(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("own"))
    subprocess.run([sys.executable, "-c", JOB, path], check=True, timeout=300, capture_output=True)
    return path


@pytest.fixture(scope="module")
def events(spark, log):
    return read_events(spark, log)


def test_compressed_rolling_log_is_read(spark, log, events):
    (folder,) = Path(log).glob("eventlog_v2_*")
    app = folder.name.removeprefix("eventlog_v2_")
    assert list(folder.glob("events_1_*.zstd"))
    lines = read_lines(spark, f"{log}/*/events_*")
    counts = {r["event"]: r["events"] for r in ops.event_log_counts(lines).collect()}
    tables = {
        "stages_started": "SparkListenerStageSubmitted",
        "stage_metrics": "SparkListenerStageCompleted",
        "jobs_ended": "SparkListenerJobEnd",
        "tasks_started": "SparkListenerTaskStart",
        "task_metrics": "SparkListenerTaskEnd",
        "executor_added": "SparkListenerExecutorAdded",
        "queries_ended": "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd",
    }
    for kind, event in tables.items():
        table = ops.record_table(events, kind)
        assert table.count() == counts[event] > 0
        assert {row["appId"] for row in table.select("appId").distinct().collect()} == {app}


def test_failures_are_seen(events):
    results = {row["jobResult"] for row in ops.record_table(events, "jobs_ended").collect()}
    assert "Succeeded" in results
    assert any(result.startswith("Failed: ") for result in results)
    failed = ops.record_table(events, "task_metrics").where("failed").collect()
    assert failed and all(row["status"] == "FAILED" for row in failed)
    assert all("is not true" in row["failureReason"] for row in failed)


def test_rollup_equals_accumulators_of_succeeded_stages(events):
    accumulated = ops.record_table(events, "stage_metrics").where("failureReason = ''")
    summed = ops.stage_rollup(events)
    keys = ("appId", "stageId", "stageAttempt", "tasks")
    counters = [name for name in summed.columns if name not in keys]
    stages = {row["stageId"]: row for row in accumulated.collect()}
    sums = {row["stageId"]: row for row in summed.collect()}
    assert stages
    for stage, row in stages.items():
        assert {c: row[c] for c in counters} == {c: sums[stage][c] for c in counters}
        assert row["numTasks"] == sums[stage]["tasks"]
