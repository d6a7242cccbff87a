"""Hand-written lines through both readers and all record kinds."""

import json

import pytest
from samplelog import COUNTER_VALUES, LINES

from pulselog import operators as ops
from pulselog import schema
from pulselog.sources import parse_events, read_events


@pytest.fixture(scope="module", params=["rows", "file"])
def events(request, spark, tmp_path_factory):
    if request.param == "rows":
        rows = [(line, "app-9") for line in LINES]
        return parse_events(spark.createDataFrame(rows, "value string, appId string"))
    folder = tmp_path_factory.mktemp("logs") / "eventlog_v2_app-9"
    folder.mkdir()
    (folder / "events_1_app-9").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (folder / "appstatus_app-9").touch()
    return read_events(spark, str(folder.parent))


def rows(events, kind, compat=False):
    return [row.asDict() for row in ops.record_table(events, kind, compat).collect()]


def test_stage_started_without_submission_time(events):
    assert rows(events, "stages_started") == [
        {
            "metricType": "stageSubmitted-3-1",
            "name": "stages_started",
            "appId": "app-9",
            "stageId": 3,
            "attemptNumber": 1,
            "submissionTime": 0,
            "epochMillis": 0,
        }
    ]


def test_stage_ended(events):
    (row,) = rows(events, "stages_ended")
    assert row["metricType"] == "stageEnd-3-1"
    assert (row["submissionTime"], row["completionTime"], row["epochMillis"]) == (900, 1600, 1600)


def test_stage_metrics(events):
    (row,) = rows(events, "stage_metrics")
    touched = {
        "executorRunTime": 40,
        "executorCpuTime": 41,
        "shuffleTotalBytesRead": 58,
        "shuffleRemoteBytesRead": 50,
        "shuffleLocalBytesRead": 8,
    }
    assert {name: row[name] for name in COUNTER_VALUES} == {
        name: touched.get(name, 0) for name in COUNTER_VALUES
    }
    assert row["failureReason"] == 'lost\n"x"'
    assert row["numTasks"] == 2
    assert rows(events, "stage_metrics", compat=True)[0]["executorCpuTime"] == 40


def test_executors(events):
    (added,) = rows(events, "executor_added")
    assert (added["executorHost"], added["totalCores"], added["time"]) == ("h1", 4, 200)
    (removed,) = rows(events, "executor_removed")
    assert (removed["reason"], removed["time"]) == ("idle", 2000)
    (excluded,) = rows(events, "executor_excluded")
    assert (excluded["taskFailures"], excluded["metricType"]) == (2, "executorExcluded-5")


def test_sql_executions(events):
    (started,) = rows(events, "queries_started")
    assert (started["description"], started["queryId"], started["startTime"]) == ("show", 0, 300)
    (ended,) = rows(events, "queries_ended")
    assert (ended["metricType"], ended["endTime"]) == ("queryEnd-0", 1800)


def test_jobs(events):
    assert sorted(row["jobId"] for row in rows(events, "jobs_started")) == [2, 6]
    (ended,) = rows(events, "jobs_ended")
    assert ended["jobResult"] == "Failed: boom"
    (ended,) = rows(events, "jobs_ended", compat=True)
    assert ended["jobResult"] == "Failed: JobFailed(org.apache.spark.SparkException: boom)"


def test_tasks(events):
    (started,) = rows(events, "tasks_started")
    assert (started["taskId"], started["launchTime"], started["epochMillis"]) == (7, 1000, 1000)
    assert {row["name"] for row in rows(events, "tasks_ended")} == {"tasks_ended"}
    assert {row["name"] for row in rows(events, "tasks_ended", compat=True)} == {"tasks_started"}


def test_task_metrics(events):
    good, bad = sorted(rows(events, "task_metrics"), key=lambda row: row["taskId"])
    assert {name: good[name] for name in COUNTER_VALUES} == COUNTER_VALUES
    assert (good["status"], good["duration"], good["taskLocality"]) == ("SUCCESS", 500, 2)
    assert (good["failureReason"], good["successful"], good["finished"]) == ("", True, True)
    assert (bad["status"], bad["failureReason"], bad["taskLocality"]) == ("FAILED", "E: bad", -1)
    assert all(bad[name] is None for name in COUNTER_VALUES)
    (compat,) = rows(events, "task_metrics", compat=True)
    assert compat["remoteBytesReadToDisk"] == 18
    assert "shuffleRemoteBytesReadToDisk" not in compat


def test_mixed_stream_holds_the_same_maps(events):
    mixed = ops.records(events, extended=True).collect()
    for kind in ops.RECORD_NAMES:
        expected = rows(events, kind)
        got = [row for row in mixed if row["name"] == kind]
        assert len(got) == len(expected)
        for row in expected:
            metric_type = row.pop("metricType")
            match = next(r for r in got if r["metricType"] == metric_type)
            assert json.loads(match["payload"]) == row
            assert match["epochMillis"] == row["epochMillis"]


def test_basic_mode_leaves_tasks_out(events):
    names = {row["name"] for row in ops.records(events).collect()}
    assert names == set(schema.BASIC_KINDS)


def test_capture_time(events):
    stamped = ops.records(events, capture_time=True).collect()
    assert all(row["epochMillis"] > 1_600_000_000_000 for row in stamped)
    assert all(json.loads(r["payload"])["epochMillis"] == r["epochMillis"] for r in stamped)


def test_application_records(events):
    start, end = sorted(ops.application_records(events).collect(), key=lambda row: row["time"])
    assert start["message"] == (
        "Spark application started, Application Name: demo, Application ID: app-9, "
        "Time: 100, Spark User: u, App Attempt ID: N/A"
    )
    assert end["message"] == "Spark application ended, timestamp = 2200"


def test_rollup_counts_tasks_without_metrics(events):
    (row,) = ops.stage_rollup(events).collect()
    assert (row["stageId"], row["stageAttempt"], row["tasks"]) == (3, 1, 2)
    assert {name: row[name] for name in COUNTER_VALUES} == COUNTER_VALUES


# How many samples each record kind yields.
SAMPLES = {
    "stageSubmitted-3-1": 4,
    "stageEnd-3-1": 5,
    "stageMetrics-3-1": 30,
    "executorExcluded-5": 2,
    "executorAdded-5": 2,
    "executorRemoved-5": 2,
    "queryStart-0": 3,
    "queryEnd-0": 3,
    "jobStart-2": 3,
    "jobStart-6": 3,
    "jobEnd-2": 3,
    "taskStart-7-1": 3,
    "taskEnd-7-1": 4,
    "taskEnd-8-1": 4,
    "taskMetrics-7-1": 30,
    "taskMetrics-8-1": 5,
}


def test_only_longs_become_samples(events):
    samples = ops.prometheus_samples(events, extended=True)
    counts = {row["type"]: row["count"] for row in samples.groupBy("type").count().collect()}
    assert counts == SAMPLES
    ints = ops.prometheus_samples(events, numeric="all").where("metric = 'totalcores'")
    assert [row["value"] for row in ints.collect()] == [4]


def test_exposition_text_and_request(events):
    texts = ops.exposition_text(events)
    (row,) = ops.push_requests(texts.where("type = 'queryEnd-0'"), "gw:1", "j", "box").collect()
    assert row["url"] == "http://gw:1/metrics/job/j/instance/box/type/queryEnd-0/appid/app-9"
    assert row["content_type"] == "text/plain"
    assert row["body"] == "endtime 1800\nepochmillis 1800\nqueryid 0\n"


def test_kafka_message(events):
    (row,) = [r for r in ops.kafka_rows(events).collect() if b'"queries_ended"' in r["value"]]
    assert row["key"] is None
    assert bytes(row["value"]).decode("utf-8") == (
        '{\n  "name" : "queries_ended",\n  "appId" : "app-9",\n  "queryId" : 0,\n'
        '  "endTime" : 1800,\n  "epochMillis" : 1800\n}'
    )
