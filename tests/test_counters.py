"""Every stage counter by value, from an accumulator of its own."""

import json

from pulselog import operators as ops
from pulselog.functions import event_name
from pulselog.sources import parse_events

# Accumulator -> value in the line.
VALUES = {
    "executorRunTime": 2,
    "executorCpuTime": 3,
    "executorDeserializeCpuTime": 5,
    "executorDeserializeTime": 7,
    "jvmGCTime": 11,
    "memoryBytesSpilled": 13,
    "peakExecutionMemory": 17,
    "resultSerializationTime": 19,
    "resultSize": 23,
    "input.bytesRead": 29,
    "input.recordsRead": 31,
    "output.bytesWritten": 37,
    "output.recordsWritten": 41,
    "shuffle.read.remoteBytesRead": 43,
    "shuffle.read.localBytesRead": 47,
    "shuffle.read.remoteBytesReadToDisk": 53,
    "shuffle.read.remoteBlocksFetched": 59,
    "shuffle.read.localBlocksFetched": 61,
    "shuffle.read.recordsRead": 67,
    "shuffle.read.fetchWaitTime": 71,
    "shuffle.write.bytesWritten": 73,
    "shuffle.write.recordsWritten": 79,
    "shuffle.write.writeTime": 83,
}
EXPECTED = {
    "executorRunTime": 2,
    "executorCpuTime": 3,
    "executorDeserializeCpuTime": 5,
    "executorDeserializeTime": 7,
    "jvmGCTime": 11,
    "memoryBytesSpilled": 13,
    "peakExecutionMemory": 17,
    "resultSerializationTime": 19,
    "resultSize": 23,
    "bytesRead": 29,
    "recordsRead": 31,
    "bytesWritten": 37,
    "recordsWritten": 41,
    "shuffleTotalBytesRead": 43 + 47,
    "shuffleRemoteBytesRead": 43,
    "shuffleRemoteBytesReadToDisk": 53,
    "shuffleLocalBytesRead": 47,
    "shuffleTotalBlocksFetched": 59 + 61,
    "shuffleLocalBlocksFetched": 61,
    "shuffleRemoteBlocksFetched": 59,
    "shuffleRecordsRead": 67,
    "shuffleFetchWaitTime": 71,
    "shuffleBytesWritten": 73,
    "shuffleRecordsWritten": 79,
    "shuffleWriteTime": 83,
}


def stage_line(entries):
    info = {
        "Stage ID": 1,
        "Stage Attempt ID": 0,
        "Number of Tasks": 1,
        "Submission Time": 10,
        "Completion Time": 20,
        "Accumulables": [{"Name": name, "Value": str(value)} for name, value in entries],
    }
    return json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": info})


def metrics(spark, entries):
    lines = spark.createDataFrame([(stage_line(entries),)], "value string")
    (row,) = ops.record_table(parse_events(lines), "stage_metrics").collect()
    return {name: row[name] for name in EXPECTED}


def test_every_stage_counter(spark):
    entries = [(f"internal.metrics.{name}", value) for name, value in VALUES.items()]
    assert metrics(spark, entries) == EXPECTED
    assert metrics(spark, entries[::-1]) == EXPECTED


def test_first_entry_of_a_name_counts(spark):
    entries = [(f"internal.metrics.{name}", value) for name, value in VALUES.items()]
    again = [("number of rows", 1), *entries, *[(name, 1000) for name, _ in entries]]
    assert metrics(spark, again) == EXPECTED


def test_broken_lines_count_alike_in_both_layouts(spark):
    lines = [
        '{"Event":"SparkListenerJobStart","Job ID":1,"Submission Time":5}',
        '{"Event":"SparkListenerJobStart","Job ID":1',
        '{ "Event":"SparkListenerJobStart","Job ID":1',
        "no json",
        " ",
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    names = [row[0] for row in frame.select(event_name(frame.value)).collect()]
    assert names == ["SparkListenerJobStart", None, None, None, None]
    counts = {row["event"]: row["events"] for row in ops.event_log_counts(frame).collect()}
    assert counts == {"SparkListenerJobStart": 1, "(unreadable)": 3}
    assert ops.record_table(parse_events(frame), "jobs_started").count() == 1
