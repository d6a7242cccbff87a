"""Event names, the event-log line schema and the list of task counters."""

from __future__ import annotations

from dataclasses import dataclass

# The `Event` names of the listener events that become records.
STAGE_SUBMITTED = "SparkListenerStageSubmitted"
STAGE_COMPLETED = "SparkListenerStageCompleted"
EXECUTOR_EXCLUDED = "org.apache.spark.scheduler.SparkListenerExecutorExcluded"
EXECUTOR_ADDED = "SparkListenerExecutorAdded"
EXECUTOR_REMOVED = "SparkListenerExecutorRemoved"
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
JOB_START = "SparkListenerJobStart"
JOB_END = "SparkListenerJobEnd"
TASK_START = "SparkListenerTaskStart"
TASK_END = "SparkListenerTaskEnd"
APPLICATION_START = "SparkListenerApplicationStart"
APPLICATION_END = "SparkListenerApplicationEnd"

# Record kind -> its event.  The last three are no records of their own: the roll-up
# of tasks to stages and the two application log lines.
KIND_EVENTS = {
    "stages_started": STAGE_SUBMITTED,
    "stages_ended": STAGE_COMPLETED,
    "stage_metrics": STAGE_COMPLETED,
    "executor_excluded": EXECUTOR_EXCLUDED,
    "executor_added": EXECUTOR_ADDED,
    "executor_removed": EXECUTOR_REMOVED,
    "queries_started": SQL_START,
    "queries_ended": SQL_END,
    "jobs_started": JOB_START,
    "jobs_ended": JOB_END,
    "tasks_started": TASK_START,
    "tasks_ended": TASK_END,
    "task_metrics": TASK_END,
    "stage_rollup": TASK_END,
    "application_started": APPLICATION_START,
    "application_ended": APPLICATION_END,
}
TASK_KINDS = ("tasks_started", "tasks_ended", "task_metrics")
APPLICATION_KINDS = ("application_started", "application_ended")
BASIC_KINDS = tuple(
    kind for kind in KIND_EVENTS if kind not in (*TASK_KINDS, *APPLICATION_KINDS, "stage_rollup")
)
EXTENDED_KINDS = BASIC_KINDS + TASK_KINDS
ALL_KINDS = EXTENDED_KINDS + ("stage_rollup",) + APPLICATION_KINDS
APPLICATION_EVENTS = (APPLICATION_START, APPLICATION_END)


def kind_events(kinds=ALL_KINDS) -> tuple[str, ...]:
    """The events that the given record kinds come from."""
    return tuple(dict.fromkeys(KIND_EVENTS[kind] for kind in kinds))


ALL_EVENTS = kind_events()

# Only the fields that some record needs.  Call sites, RDD infos, stage infos of
# job starts, plan texts and per-task accumulables are left out, so the JSON
# parser steps over them without building values.
_STAGE_INFO = """struct<
    `Stage ID`: bigint, `Stage Attempt ID`: int, `Number of Tasks`: int,
    `Submission Time`: bigint, `Completion Time`: bigint, `Failure Reason`: string,
    Accumulables: array<struct<Name: string, Value: string>>>"""

_TASK_INFO = """struct<
    `Task ID`: bigint, Attempt: int, `Launch Time`: bigint, `Finish Time`: bigint,
    `Getting Result Time`: bigint, `Executor ID`: string, Host: string, Locality: string,
    Speculative: boolean, Failed: boolean, Killed: boolean>"""

_TASK_END_REASON = """struct<
    Reason: string, Description: string, `Class Name`: string, `Full Stack Trace`: string,
    `Stack Trace`: array<struct<`Declaring Class`: string, `Method Name`: string,
        `File Name`: string, `Line Number`: int>>,
    `Kill Reason`: string, Message: string, `Loss Reason`: string, `Executor ID`: string,
    `Exit Caused By App`: boolean, `Block Manager Address`:
        struct<`Executor ID`: string, Host: string, Port: int>,
    `Shuffle ID`: int, `Map ID`: bigint, `Map Index`: int, `Reduce ID`: int,
    `Job ID`: int, `Partition ID`: int, `Attempt Number`: int>"""

_TASK_METRICS = """struct<
    `Executor Run Time`: bigint, `Executor CPU Time`: bigint,
    `Executor Deserialize CPU Time`: bigint, `Executor Deserialize Time`: bigint,
    `JVM GC Time`: bigint, `Memory Bytes Spilled`: bigint, `Peak Execution Memory`: bigint,
    `Result Serialization Time`: bigint, `Result Size`: bigint,
    `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>,
    `Output Metrics`: struct<`Bytes Written`: bigint, `Records Written`: bigint>,
    `Shuffle Read Metrics`: struct<
        `Remote Bytes Read`: bigint, `Local Bytes Read`: bigint,
        `Remote Bytes Read To Disk`: bigint, `Local Blocks Fetched`: bigint,
        `Remote Blocks Fetched`: bigint, `Total Records Read`: bigint,
        `Fetch Wait Time`: bigint>,
    `Shuffle Write Metrics`: struct<
        `Shuffle Bytes Written`: bigint, `Shuffle Records Written`: bigint,
        `Shuffle Write Time`: bigint>>"""

# Top-level line fields and the record kinds that need them.
_STAGES = ("stages_started", "stages_ended", "stage_metrics")
_JOBS = ("jobs_started", "jobs_ended")
_TASKS = (*TASK_KINDS, "stage_rollup")
_EXECUTORS = ("executor_added", "executor_removed")
_SQL = ("queries_started", "queries_ended")
_LINE_FIELDS = (
    ("Stage Info", _STAGE_INFO, _STAGES),
    ("Job ID", "bigint", _JOBS),
    ("Submission Time", "bigint", ("jobs_started",)),
    ("Completion Time", "bigint", ("jobs_ended",)),
    ("Job Result", "struct<Result: string, Exception: struct<Message: string>>", ("jobs_ended",)),
    ("Stage ID", "bigint", _TASKS),
    ("Stage Attempt ID", "int", ("stage_rollup",)),
    ("Task Info", _TASK_INFO, _TASKS),
    ("Task End Reason", _TASK_END_REASON, ("task_metrics",)),
    ("Task Metrics", _TASK_METRICS, ("task_metrics", "stage_rollup")),
    ("Timestamp", "bigint", _EXECUTORS + APPLICATION_KINDS),
    ("Executor ID", "string", _EXECUTORS),
    ("Executor Info", "struct<Host: string, `Total Cores`: int>", ("executor_added",)),
    ("Removed Reason", "string", ("executor_removed",)),
    ("executorId", "string", ("executor_excluded",)),
    ("taskFailures", "int", ("executor_excluded",)),
    ("time", "bigint", ("executor_excluded", *_SQL)),
    ("executionId", "bigint", _SQL),
    ("description", "string", ("queries_started",)),
    ("App Name", "string", ("application_started",)),
    ("App ID", "string", ("application_started",)),
    ("App Attempt ID", "string", ("application_started",)),
    ("User", "string", ("application_started",)),
)


def line_fields(kinds=ALL_KINDS) -> list[str]:
    """Names of the top-level line fields that the given record kinds need."""
    return [name for name, _, users in _LINE_FIELDS if set(users) & set(kinds)]


def line_ddl(kinds=ALL_KINDS, with_event: bool = True) -> str:
    """DDL schema of an event-log line, narrowed to what the record kinds need."""
    fields = [f"`{name}` {ddl}" for name, ddl, users in _LINE_FIELDS if set(users) & set(kinds)]
    return ", ".join((["Event string"] if with_event else []) + fields)


@dataclass(frozen=True)
class Counter:
    """One of the 25 task counters.

    ``task`` holds dotted paths below `Task Metrics`, ``stage`` the accumulator
    names below ``internal.metrics.``; several entries are added up.
    """

    name: str
    task: tuple[str, ...]
    stage: tuple[str, ...]


def _counter(name: str, task: str, stage: str | None = None) -> Counter:
    return Counter(name, tuple(task.split("+")), tuple((stage or name).split("+")))


_IN, _OUT, _READ, _WRITE = (
    "Input Metrics",
    "Output Metrics",
    "Shuffle Read Metrics",
    "Shuffle Write Metrics",
)

# Record column, task metric path, stage accumulator.
COUNTERS = (
    _counter("executorRunTime", "Executor Run Time"),
    _counter("executorCpuTime", "Executor CPU Time"),
    _counter("executorDeserializeCpuTime", "Executor Deserialize CPU Time"),
    _counter("executorDeserializeTime", "Executor Deserialize Time"),
    _counter("jvmGCTime", "JVM GC Time"),
    _counter("memoryBytesSpilled", "Memory Bytes Spilled"),
    _counter("peakExecutionMemory", "Peak Execution Memory"),
    _counter("resultSerializationTime", "Result Serialization Time"),
    _counter("resultSize", "Result Size"),
    _counter("bytesRead", f"{_IN}.Bytes Read", "input.bytesRead"),
    _counter("recordsRead", f"{_IN}.Records Read", "input.recordsRead"),
    _counter("bytesWritten", f"{_OUT}.Bytes Written", "output.bytesWritten"),
    _counter("recordsWritten", f"{_OUT}.Records Written", "output.recordsWritten"),
    _counter(
        "shuffleTotalBytesRead",
        f"{_READ}.Remote Bytes Read+{_READ}.Local Bytes Read",
        "shuffle.read.remoteBytesRead+shuffle.read.localBytesRead",
    ),
    _counter(
        "shuffleRemoteBytesRead", f"{_READ}.Remote Bytes Read", "shuffle.read.remoteBytesRead"
    ),
    _counter(
        "shuffleRemoteBytesReadToDisk",
        f"{_READ}.Remote Bytes Read To Disk",
        "shuffle.read.remoteBytesReadToDisk",
    ),
    _counter("shuffleLocalBytesRead", f"{_READ}.Local Bytes Read", "shuffle.read.localBytesRead"),
    _counter(
        "shuffleTotalBlocksFetched",
        f"{_READ}.Remote Blocks Fetched+{_READ}.Local Blocks Fetched",
        "shuffle.read.remoteBlocksFetched+shuffle.read.localBlocksFetched",
    ),
    _counter(
        "shuffleLocalBlocksFetched",
        f"{_READ}.Local Blocks Fetched",
        "shuffle.read.localBlocksFetched",
    ),
    _counter(
        "shuffleRemoteBlocksFetched",
        f"{_READ}.Remote Blocks Fetched",
        "shuffle.read.remoteBlocksFetched",
    ),
    _counter("shuffleRecordsRead", f"{_READ}.Total Records Read", "shuffle.read.recordsRead"),
    _counter("shuffleFetchWaitTime", f"{_READ}.Fetch Wait Time", "shuffle.read.fetchWaitTime"),
    _counter(
        "shuffleBytesWritten", f"{_WRITE}.Shuffle Bytes Written", "shuffle.write.bytesWritten"
    ),
    _counter(
        "shuffleRecordsWritten", f"{_WRITE}.Shuffle Records Written", "shuffle.write.recordsWritten"
    ),
    _counter("shuffleWriteTime", f"{_WRITE}.Shuffle Write Time", "shuffle.write.writeTime"),
)
ACCUMULATOR_PREFIX = "internal.metrics."
