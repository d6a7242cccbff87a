"""What each listener event turns into: thirteen record kinds.

A record kind is a set of SQL expressions over a parsed event row (see
``pulselog.sources``).  Two families of renderers use it: typed tables, one per
kind, and the mixed stream, where one pass over the events emits all kinds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselog import schema
from pulselog.functions.tasks import (
    failure_text,
    job_result_text,
    task_duration,
    task_finished,
    task_locality_code,
    task_status,
    task_successful,
)

STAGE_COUNTERS = "_stage_counters"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    sql: str

    @property
    def value(self) -> str:
        return f"CAST({self.sql} AS {self.type})"


@dataclass(frozen=True)
class Record:
    """One record kind.

    ``key`` is the prefix and the columns of the metric type, ``time`` the event
    time, ``present`` tells whether the event row carries such a record.
    """

    name: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    time: str
    present: str

    @property
    def metric_type(self) -> str:
        prefix, *parts = self.key
        return f"concat_ws('-', '{prefix}', {', '.join(f'CAST({p} AS string)' for p in parts)})"

    def entries(self, epoch: str | None = None) -> list[Field]:
        """All entries of the record's map, in declared order."""
        return [
            Field("name", "string", f"'{self.name}'"),
            Field("appId", "string", "appId"),
            *self.fields,
            Field("epochMillis", "bigint", epoch or self.time),
        ]


def _long(name: str, sql: str) -> Field:
    return Field(name, "bigint", sql)


def _int(name: str, sql: str) -> Field:
    return Field(name, "int", sql)


def _text(name: str, sql: str) -> Field:
    return Field(name, "string", sql)


def _flag(name: str, sql: str) -> Field:
    return Field(name, "boolean", sql)


def _or_zero(sql: str) -> str:
    return f"coalesce({sql}, 0L)"


def _path(path: str) -> str:
    return ".".join(f"`{step}`" for step in path.split("."))


def with_stage_counters(events: DataFrame) -> DataFrame:
    """Adds the stage's accumulator values as ``map<suffix, bigint>``.

    Built in projections of its own, once per row, because all stage counters
    look into it.  Should a name come up twice, the first entry counts.
    """
    if "Stage Info" not in events.columns:
        return events
    prefix = schema.ACCUMULATOR_PREFIX
    internal = f"filter(`Stage Info`.Accumulables, a -> startswith(a.Name, '{prefix}'))"
    # Sorted by name and place, the first entry of a name is the one behind another name.
    internal = f"array_sort(transform({internal}, (a, i) -> struct(a.Name, i AS at, a.Value)))"
    first = "filter(_internal, (a, i) -> NOT (get(_internal, i - 1).Name <=> a.Name))"
    entries = (
        f"transform({first}, a -> struct("
        f"substring(a.Name, {len(prefix) + 1}), try_cast(a.Value AS bigint)))"
    )
    return (
        events.withColumn("_internal", F.expr(internal))
        .withColumn(STAGE_COUNTERS, F.expr(f"map_from_entries({entries})"))
        .drop("_internal")
    )


def task_counters() -> list[Field]:
    """The 25 counters of a task: 0 where the log leaves one out, null without task metrics."""

    def value(counter: schema.Counter) -> str:
        total = " + ".join(_or_zero(f"`Task Metrics`.{_path(path)}") for path in counter.task)
        return f"IF(`Task Metrics` IS NOT NULL, {total}, NULL)"

    return [_long(counter.name, value(counter)) for counter in schema.COUNTERS]


def _stage_counters() -> list[Field]:
    """The 25 counters of a stage; a counter the stage never touched is 0."""

    def value(counter: schema.Counter) -> str:
        return " + ".join(_or_zero(f"{STAGE_COUNTERS}['{name}']") for name in counter.stage)

    return [_long(counter.name, value(counter)) for counter in schema.COUNTERS]


# Fixed values from here on: record names, metric-type prefixes, field names and their order.
_STAGE_KEY = ("`Stage Info`.`Stage ID`", "`Stage Info`.`Stage Attempt ID`")
_STAGE_PRESENT = "`Stage Info`.`Stage ID` IS NOT NULL"
_STAGE_SUBMISSION = _or_zero("`Stage Info`.`Submission Time`")
_STAGE_IDENTITY = (
    _long("stageId", "`Stage Info`.`Stage ID`"),
    _long("attemptNumber", "`Stage Info`.`Stage Attempt ID`"),
    _long("submissionTime", _STAGE_SUBMISSION),
)


def _stage_submitted(compat: bool) -> list[Record]:
    return [
        Record(
            "stages_started",
            ("stageSubmitted", *_STAGE_KEY),
            _STAGE_IDENTITY,
            _STAGE_SUBMISSION,
            _STAGE_PRESENT,
        )
    ]


def _stage_completed(compat: bool) -> list[Record]:
    completed = _or_zero("`Stage Info`.`Completion Time`")
    shared = (*_STAGE_IDENTITY, _long("completionTime", completed))
    counters = _stage_counters()
    if compat:
        run_time = counters[0].sql
        counters = [
            _long(c.name, run_time) if c.name == "executorCpuTime" else c for c in counters
        ]
    return [
        Record("stages_ended", ("stageEnd", *_STAGE_KEY), shared, completed, _STAGE_PRESENT),
        Record(
            "stage_metrics",
            ("stageMetrics", *_STAGE_KEY),
            (
                *shared,
                _text("failureReason", "coalesce(`Stage Info`.`Failure Reason`, '')"),
                *counters,
                _int("numTasks", "`Stage Info`.`Number of Tasks`"),
            ),
            completed,
            _STAGE_PRESENT,
        ),
    ]


def _executor_excluded(compat: bool) -> list[Record]:
    return [
        Record(
            "executor_excluded",
            ("executorExcluded", "executorId"),
            (
                _long("time", "time"),
                _text("executorId", "executorId"),
                _int("taskFailures", "taskFailures"),
            ),
            "time",
            "executorId IS NOT NULL",
        )
    ]


def _executor_added(compat: bool) -> list[Record]:
    return [
        Record(
            "executor_added",
            ("executorAdded", "`Executor ID`"),
            (
                _long("time", "Timestamp"),
                _text("executorId", "`Executor ID`"),
                _text("executorHost", "`Executor Info`.Host"),
                _int("totalCores", "`Executor Info`.`Total Cores`"),
            ),
            "Timestamp",
            "`Executor ID` IS NOT NULL",
        )
    ]


def _executor_removed(compat: bool) -> list[Record]:
    return [
        Record(
            "executor_removed",
            ("executorRemoved", "`Executor ID`"),
            (
                _long("time", "Timestamp"),
                _text("executorId", "`Executor ID`"),
                _text("reason", "`Removed Reason`"),
            ),
            "Timestamp",
            "`Executor ID` IS NOT NULL",
        )
    ]


def _sql_start(compat: bool) -> list[Record]:
    return [
        Record(
            "queries_started",
            ("queryStart", "executionId"),
            (
                _text("description", "description"),
                _long("queryId", "executionId"),
                _long("startTime", "time"),
            ),
            "time",
            "executionId IS NOT NULL",
        )
    ]


def _sql_end(compat: bool) -> list[Record]:
    return [
        Record(
            "queries_ended",
            ("queryEnd", "executionId"),
            (_long("queryId", "executionId"), _long("endTime", "time")),
            "time",
            "executionId IS NOT NULL",
        )
    ]


def _job_start(compat: bool) -> list[Record]:
    return [
        Record(
            "jobs_started",
            ("jobStart", "`Job ID`"),
            (_long("jobId", "`Job ID`"), _long("startTime", "`Submission Time`")),
            "`Submission Time`",
            "`Job ID` IS NOT NULL",
        )
    ]


def _job_end(compat: bool) -> list[Record]:
    return [
        Record(
            "jobs_ended",
            ("jobEnd", "`Job ID`"),
            (
                _long("jobId", "`Job ID`"),
                _long("completionTime", "`Completion Time`"),
                _text("jobResult", job_result_text("`Job Result`", compat)),
            ),
            "`Completion Time`",
            "`Job ID` IS NOT NULL",
        )
    ]


_TASK_INFO = "`Task Info`"
_TASK_KEY = (f"{_TASK_INFO}.`Task ID`", f"{_TASK_INFO}.Attempt")
_TASK_PRESENT = f"{_TASK_INFO}.`Task ID` IS NOT NULL"
_TASK_IDENTITY = (
    _long("taskId", f"{_TASK_INFO}.`Task ID`"),
    _int("attemptNumber", f"{_TASK_INFO}.Attempt"),
    _int("stageId", "`Stage ID`"),
    _long("launchTime", f"{_TASK_INFO}.`Launch Time`"),
)


def _task_start(compat: bool) -> list[Record]:
    return [
        Record(
            "tasks_started",
            ("taskStart", *_TASK_KEY),
            _TASK_IDENTITY,
            f"{_TASK_INFO}.`Launch Time`",
            _TASK_PRESENT,
        )
    ]


def _task_end(compat: bool) -> list[Record]:
    finish = f"{_TASK_INFO}.`Finish Time`"
    shared = (*_TASK_IDENTITY, _long("finishTime", finish))
    counters = task_counters()
    measured = _TASK_PRESENT
    if compat:
        counters = [
            _long("remoteBytesReadToDisk", c.sql) if c.name.endswith("ReadToDisk") else c
            for c in counters
        ]
        # A listener cannot report a task without metrics or finish time.
        measured += f" AND `Task Metrics` IS NOT NULL AND {task_finished(_TASK_INFO)}"
    return [
        Record(
            "tasks_started" if compat else "tasks_ended",
            ("taskEnd", *_TASK_KEY),
            shared,
            finish,
            _TASK_PRESENT,
        ),
        Record(
            "task_metrics",
            ("taskMetrics", *_TASK_KEY),
            (
                *shared,
                _text("status", task_status(_TASK_INFO)),
                _flag("failed", f"{_TASK_INFO}.Failed"),
                _text("failureReason", failure_text("`Task End Reason`")),
                _flag("speculative", f"{_TASK_INFO}.Speculative"),
                _flag("killed", f"{_TASK_INFO}.Killed"),
                _flag("finished", task_finished(_TASK_INFO)),
                _text("executorId", f"{_TASK_INFO}.`Executor ID`"),
                _long("duration", task_duration(_TASK_INFO)),
                _flag("successful", task_successful(_TASK_INFO)),
                _text("host", f"{_TASK_INFO}.Host"),
                _int("taskLocality", task_locality_code(f"{_TASK_INFO}.Locality")),
                *counters,
            ),
            finish,
            measured,
        ),
    ]


BASIC = {
    schema.STAGE_SUBMITTED: _stage_submitted,
    schema.STAGE_COMPLETED: _stage_completed,
    schema.EXECUTOR_EXCLUDED: _executor_excluded,
    schema.EXECUTOR_ADDED: _executor_added,
    schema.EXECUTOR_REMOVED: _executor_removed,
    schema.SQL_START: _sql_start,
    schema.SQL_END: _sql_end,
    schema.JOB_START: _job_start,
    schema.JOB_END: _job_end,
}
TASK = {schema.TASK_START: _task_start, schema.TASK_END: _task_end}


def kind_record(kind: str, compat: bool = False) -> Record:
    """The record of a kind.  In compat mode a task end is only *named* like a task start."""
    event = schema.KIND_EVENTS[kind]
    siblings = [k for k in schema.EXTENDED_KINDS if schema.KIND_EVENTS[k] == event]
    return {**BASIC, **TASK}[event](compat)[siblings.index(kind)]
