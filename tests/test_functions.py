import json

import pytest
from pyspark.sql import functions as F

from pulselog import operators as ops
from pulselog import schema
from pulselog.functions import (
    app_id_from_path,
    epoch_micros,
    event_name,
    order_key,
    sanitize_label_name,
    sanitize_metric_name,
)
from pulselog.functions.tasks import failure_text, task_status
from pulselog.operators.catalogue import BASIC, TASK
from pulselog.operators.exposition import sample_values
from pulselog.schema import line_ddl


def apply(spark, function, values, type_="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


NAMES = ["9a-b", " a.b:c ", "--", None, "", "ok_1", "é1", "1", "a\tb", "x😀y"]


def test_sanitize_metric_name(spark):
    assert apply(spark, sanitize_metric_name, NAMES) == [
        "_9a_b", "a_b:c", "", None, "", "ok_1", "_1", "_1", "a_b", "x_y",
    ]


def test_sanitize_label_name(spark):
    assert apply(spark, sanitize_label_name, [" a.b:c ", "a:b"]) == ["a_b_c", "a_b"]


def test_sample_names_are_sanitised_already(spark):
    records = [r for build in (*BASIC.values(), *TASK.values()) for r in build(False)]
    names = sorted({name for record in records for name in sample_values(record, "all")})
    assert apply(spark, sanitize_metric_name, names) == names


def test_push_url_defaults(spark):
    parts = spark.createDataFrame(
        [("", None, ""), (None, "--", None), ("testType", "testLabelName", "testLabelValue")],
        "t string, n string, v string",
    )
    url = ops.push_url("h:1", "test-job", F.col("t"), F.col("n"), F.col("v"), "box")
    base = "http://h:1/metrics/job/test-job/instance/box/type/"
    assert [row[0] for row in parts.select(url).collect()] == [
        base + "NoType/NoLabelName/NoLabelValue",
        base + "NoType/NoLabelName/NoLabelValue",
        base + "testType/testLabelName/testLabelValue",
    ]


def test_event_name(spark):
    lines = [
        '{"Event":"A","x":"B"}',
        '{"x": 1, "Event": "C"}',
        '{ "Event" : "D" }',
        "",
        "no json",
        '{"Event":"E","tr',
    ]
    assert apply(spark, event_name, lines) == ["A", "C", "D", None, None, None]


def test_app_id_from_path(spark):
    paths = {
        "file:/l/eventlog_v2_local-17/events_1_local-17.zstd": "local-17",
        "/l/eventlog_v2_application_17_0001_2/events_3_application_17_0001_2": "application_17_0001",
        "hdfs://n/l/app-2024-0001": "app-2024-0001",
        "/l/application_17_0002_1.zstd.inprogress": "application_17_0002",
        "/l/application_17_0003.zstd": "application_17_0003",
        "/l/appId=my%3Aapp/part-0.gz": "my:app",
    }
    assert apply(spark, app_id_from_path, paths) == list(paths.values())


REASONS = [
    {"Reason": "Success"},
    {
        "Reason": "ExceptionFailure",
        "Class Name": "x.E",
        "Description": "d",
        "Stack Trace": [],
        "Full Stack Trace": "x.E: d\n\tat y",
        "Accumulator Updates": [],
    },
    {
        "Reason": "FetchFailed",
        "Block Manager Address": {"Executor ID": "1", "Host": "h", "Port": 7},
        "Shuffle ID": 1,
        "Map ID": 2,
        "Map Index": 3,
        "Reduce ID": 4,
        "Message": "gone",
    },
    {"Reason": "TaskKilled", "Kill Reason": "stage cancelled", "Accumulator Updates": []},
    {"Reason": "TaskCommitDenied", "Job ID": 1, "Partition ID": 2, "Attempt Number": 3},
    {
        "Reason": "ExecutorLostFailure",
        "Executor ID": "4",
        "Exit Caused By App": False,
        "Loss Reason": "node gone",
    },
    {
        "Reason": "ExecutorLostFailure",
        "Executor ID": "4",
        "Exit Caused By App": True,
        "Loss Reason": "oom",
    },
    {"Reason": "Resubmitted"},
    {"Reason": "TaskResultLost"},
    {"Reason": "UnknownReason"},
]


def test_failure_text_is_worded_as_spark_words_it(spark):
    mapper = spark._jvm.com.fasterxml.jackson.databind.ObjectMapper()
    protocol = spark._jvm.org.apache.spark.util.JsonProtocol

    def spoken(reason):
        if reason["Reason"] == "Success":
            return ""
        parsed = protocol.taskEndReasonFromJson(mapper.readTree(json.dumps(reason)))
        return parsed.toErrorString()

    ddl = line_ddl(("task_metrics",), with_event=False)
    lines = [json.dumps({"Task End Reason": reason}) for reason in REASONS]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, v string")
    rows = (
        frame.select("i", F.from_json("v", ddl).alias("p"))
        .selectExpr("i", f"{failure_text('p.`Task End Reason`')} AS text")
        .orderBy("i")
        .collect()
    )
    assert [row["text"] for row in rows] == [spoken(reason) for reason in REASONS]


@pytest.mark.parametrize(
    "info, status",
    [
        ({"Finish Time": 0, "Getting Result Time": 0}, "RUNNING"),
        ({"Finish Time": 0, "Getting Result Time": 5}, "GET RESULT"),
        ({"Finish Time": 9, "Failed": True, "Killed": True}, "FAILED"),
        ({"Finish Time": 9, "Failed": False, "Killed": True}, "KILLED"),
        ({"Finish Time": 9, "Failed": False, "Killed": False}, "SUCCESS"),
        ({"Finish Time": 9}, "SUCCESS"),
    ],
)
def test_task_status(spark, info, status):
    ddl = line_ddl(("tasks_ended",), with_event=False)
    line = json.dumps({"Task Info": info})
    frame = spark.createDataFrame([(line,)], "v string").select(F.from_json("v", ddl).alias("p"))
    assert frame.selectExpr(task_status("p.`Task Info`")).first()[0] == status


def test_order_key_orders_pairs(spark):
    edge = 2**63 - 1
    pairs = [(-5, 0), (0, -edge), (0, edge), (1, -edge), (1, 0), (10**17, edge), (10**18, -1)]
    frame = spark.createDataFrame(pairs, "t bigint, s bigint")
    keys = [row[0] for row in frame.select(order_key(F.col("t"), F.col("s"))).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_epoch_micros_ignores_the_session_zone(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS t")
    assert frame.select(epoch_micros(F.col("t"))).first()[0] == 1710037800123456


def test_failure_from_frames(spark):
    """An exception without full trace is its class, description and frames, as Spark prints them."""
    frame = lambda c, m, f, n: {
        "Declaring Class": c, "Method Name": m, "File Name": f, "Line Number": n
    }
    frames = [
        frame("a.B", "run", "B.scala", 7), frame("a.C", "n", None, -2), frame("a.D", "<init>", None, 5),
        frame("a.E$", "x", "E.java", -1), frame("a.F", "y", "F.java", 0),
    ]
    reasons = [
        {"Reason": "ExceptionFailure", "Class Name": "x.E", "Description": "d", "Stack Trace": frames},
        {"Reason": "ExceptionFailure", "Class Name": "x.E", "Stack Trace": frames[:1]},
        {"Reason": "ExceptionFailure", "Class Name": "x.E", "Description": "d", "Stack Trace": []},
        {"Reason": "ExceptionFailure", "Class Name": "x.E", "Description": "d",
         "Stack Trace": frames, "Full Stack Trace": "whole"},
        {"Reason": "ExceptionFailure", "Class Name": "x.E", "Description": "d"},
    ]
    lines = [(n, json.dumps({"r": reason})) for n, reason in enumerate(reasons)]
    parsed = spark.createDataFrame(lines, "n int, line string").select(
        "n", F.from_json("line", f"r {schema._TASK_END_REASON}").alias("p")
    )
    got = parsed.orderBy("n").selectExpr(f"{failure_text('p.r')} AS text").collect()
    assert [row.text for row in got] == [
        "x.E: d\n        a.B.run(B.scala:7)\n        a.C.n(Native Method)\n"
        "        a.D.<init>(Unknown Source)\n        a.E$.x(E.java)\n        a.F.y(F.java:0)",
        "x.E: \n        a.B.run(B.scala:7)",
        "x.E: d\n",
        "whole",
        "x.E: d",
    ]
