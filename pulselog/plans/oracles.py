"""DuckDB SQL that computes the expected rows of the named queries from the tables.

Only the inputs of the table bindings are shared with the engine; everything a
record derives from them is stated here once more, in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pulselog.sources import table_logs as logs

JOB = "telemetry"
INSTANCE = "pulselog"
GATEWAY = "gateway:9091"


def _select(expressions: dict[str, str], relation: str) -> str:
    columns = ", ".join(f'{sql} AS "{name}"' for name, sql in expressions.items())
    return f"SELECT {columns} FROM {relation}"


_ITEMS = "(SELECT *, epoch_us(l_shipdate) // 1000 AS ship_ms FROM lineitem)"
_ORDERS = "(SELECT *, epoch_us(o_orderdate) // 1000 AS order_ms FROM orders)"
_EVENTS = "(SELECT *, epoch_us(ts) // 1000 AS event_ms FROM events)"

# Record column -> metric paths that are summed up for it. Stated here once more,
# so that a mix-up in the engine's own list shows.
_READ, _WRITE = "Shuffle Read Metrics", "Shuffle Write Metrics"
_PATHS = {
    "executorRunTime": ("Executor Run Time",),
    "executorCpuTime": ("Executor CPU Time",),
    "executorDeserializeCpuTime": ("Executor Deserialize CPU Time",),
    "executorDeserializeTime": ("Executor Deserialize Time",),
    "jvmGCTime": ("JVM GC Time",),
    "memoryBytesSpilled": ("Memory Bytes Spilled",),
    "peakExecutionMemory": ("Peak Execution Memory",),
    "resultSerializationTime": ("Result Serialization Time",),
    "resultSize": ("Result Size",),
    "bytesRead": ("Input Metrics.Bytes Read",),
    "recordsRead": ("Input Metrics.Records Read",),
    "bytesWritten": ("Output Metrics.Bytes Written",),
    "recordsWritten": ("Output Metrics.Records Written",),
    "shuffleTotalBytesRead": (f"{_READ}.Remote Bytes Read", f"{_READ}.Local Bytes Read"),
    "shuffleRemoteBytesRead": (f"{_READ}.Remote Bytes Read",),
    "shuffleRemoteBytesReadToDisk": (f"{_READ}.Remote Bytes Read To Disk",),
    "shuffleLocalBytesRead": (f"{_READ}.Local Bytes Read",),
    "shuffleTotalBlocksFetched": (
        f"{_READ}.Remote Blocks Fetched",
        f"{_READ}.Local Blocks Fetched",
    ),
    "shuffleLocalBlocksFetched": (f"{_READ}.Local Blocks Fetched",),
    "shuffleRemoteBlocksFetched": (f"{_READ}.Remote Blocks Fetched",),
    "shuffleRecordsRead": (f"{_READ}.Total Records Read",),
    "shuffleFetchWaitTime": (f"{_READ}.Fetch Wait Time",),
    "shuffleBytesWritten": (f"{_WRITE}.Shuffle Bytes Written",),
    "shuffleRecordsWritten": (f"{_WRITE}.Shuffle Records Written",),
    "shuffleWriteTime": (f"{_WRITE}.Shuffle Write Time",),
}

_stage_sums = ", ".join(
    f'CAST(sum({sql}) AS BIGINT) AS "{path}"' for path, sql in logs.TASK_COUNTERS.items()
)
_stage_extras = ", ".join(f'{sql} AS "{name}"' for name, sql in logs.STAGE.items())
_INPUTS = {
    "task": _select({**logs.TASK, **logs.TASK_COUNTERS}, _ITEMS),
    "stage": f"""SELECT *, {_stage_extras} FROM (
        SELECT l_suppkey, min(ship_ms) AS first_ms, max(ship_ms) AS last_ms,
            CAST(count(*) AS INTEGER) AS tasks, {_stage_sums}
        FROM {_ITEMS} GROUP BY l_suppkey)""",
    "job": _select(logs.JOB, _ORDERS),
    "executor": _select(logs.EXECUTOR, "supplier"),
    "sql": _select(logs.SQL, _EVENTS),
    "app": _select(logs.APPLICATION, "customer"),
}


@dataclass(frozen=True)
class Kind:
    """Expected record: its input, key, fields ``name -> (type, sql)`` and time."""

    name: str
    source: str
    key: str
    fields: dict[str, tuple[str, str]]
    time: str
    where: str = "true"

    @property
    def entries(self) -> dict[str, tuple[str, str]]:
        return {
            "name": ("string", f"'{self.name}'"),
            "appId": ("string", "app_id"),
            **self.fields,
            "epochMillis": ("long", self.time),
        }

    def rows(self, columns: str) -> str:
        return f"SELECT {columns} FROM ({_INPUTS[self.source]}) WHERE {self.where}"


_SQL_TYPES = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _sum(paths: tuple[str, ...]) -> str:
    return " + ".join(f'"{path}"' for path in paths)


_STAGE_ID = {
    "stageId": ("long", "l_suppkey"),
    "attemptNumber": ("long", "0"),
    "submissionTime": ("long", "CASE WHEN no_submission THEN 0 ELSE first_ms END"),
}
_STAGE_END = {**_STAGE_ID, "completionTime": ("long", "last_ms")}
_FINISH = "CASE WHEN unfinished THEN 0 ELSE launch_ms + duration_ms END"
_TASK_ID = {
    "taskId": ("long", "task_id"),
    "attemptNumber": ("int", "attempt"),
    "stageId": ("int", "stage_id"),
    "launchTime": ("long", "launch_ms"),
}
_TASK_END = {**_TASK_ID, "finishTime": ("long", _FINISH)}
_EXECUTOR_ID = {"time": ("long", "time_ms"), "executorId": ("string", "executor_id")}


def _task_counters(compat: bool) -> dict[str, tuple[str, str]]:
    return {
        "remoteBytesReadToDisk" if compat and name == "shuffleRemoteBytesReadToDisk" else name: (
            "long",
            f"CASE WHEN NOT without_metrics THEN {_sum(paths)} END",
        )
        for name, paths in _PATHS.items()
    }


def _stage_counters(compat: bool) -> dict[str, tuple[str, str]]:
    counters = {name: ("long", _sum(paths)) for name, paths in _PATHS.items()}
    if compat:
        counters["executorCpuTime"] = counters["executorRunTime"]
    return counters


def _kinds(compat: bool = False) -> dict[str, Kind]:
    failure = "Failed: JobFailed(org.apache.spark.SparkException: " if compat else "Failed: "
    close = ")" if compat else ""
    kinds = {
        "stages_started": Kind(
            "stages_started",
            "stage",
            "concat('stageSubmitted-', l_suppkey, '-0')",
            _STAGE_ID,
            _STAGE_ID["submissionTime"][1],
        ),
        "stages_ended": Kind(
            "stages_ended", "stage", "concat('stageEnd-', l_suppkey, '-0')", _STAGE_END, "last_ms"
        ),
        "stage_metrics": Kind(
            "stage_metrics",
            "stage",
            "concat('stageMetrics-', l_suppkey, '-0')",
            {
                **_STAGE_END,
                "failureReason": ("string", "coalesce(failure, '')"),
                **_stage_counters(compat),
                "numTasks": ("int", "tasks"),
            },
            "last_ms",
        ),
        "executor_excluded": Kind(
            "executor_excluded",
            "executor",
            "concat('executorExcluded-', executor_id)",
            {**_EXECUTOR_ID, "taskFailures": ("int", "failures")},
            "time_ms",
        ),
        "executor_added": Kind(
            "executor_added",
            "executor",
            "concat('executorAdded-', executor_id)",
            {**_EXECUTOR_ID, "executorHost": ("string", "host"), "totalCores": ("int", "cores")},
            "time_ms",
        ),
        "executor_removed": Kind(
            "executor_removed",
            "executor",
            "concat('executorRemoved-', executor_id)",
            {**_EXECUTOR_ID, "reason": ("string", "reason")},
            "time_ms",
        ),
        "queries_started": Kind(
            "queries_started",
            "sql",
            "concat('queryStart-', query_id)",
            {
                "description": ("string", "description"),
                "queryId": ("long", "query_id"),
                "startTime": ("long", "start_ms"),
            },
            "start_ms",
        ),
        "queries_ended": Kind(
            "queries_ended",
            "sql",
            "concat('queryEnd-', query_id)",
            {"queryId": ("long", "query_id"), "endTime": ("long", "end_ms")},
            "end_ms",
        ),
        "jobs_started": Kind(
            "jobs_started",
            "job",
            "concat('jobStart-', job_id)",
            {"jobId": ("long", "job_id"), "startTime": ("long", "start_ms")},
            "start_ms",
        ),
        "jobs_ended": Kind(
            "jobs_ended",
            "job",
            "concat('jobEnd-', job_id)",
            {
                "jobId": ("long", "job_id"),
                "completionTime": ("long", "end_ms"),
                "jobResult": (
                    "string",
                    f"CASE WHEN failed THEN '{failure}' || message || '{close}' ELSE 'Succeeded' END",
                ),
            },
            "end_ms",
        ),
        "tasks_started": Kind(
            "tasks_started",
            "task",
            "concat('taskStart-', task_id, '-', attempt)",
            _TASK_ID,
            "launch_ms",
        ),
        "tasks_ended": Kind(
            "tasks_started" if compat else "tasks_ended",
            "task",
            "concat('taskEnd-', task_id, '-', attempt)",
            _TASK_END,
            _FINISH,
        ),
        "task_metrics": Kind(
            "task_metrics",
            "task",
            "concat('taskMetrics-', task_id, '-', attempt)",
            {
                **_TASK_END,
                "status": (
                    "string",
                    "CASE WHEN unfinished THEN CASE WHEN getting_result_ms <> 0 THEN 'GET RESULT' "
                    "ELSE 'RUNNING' END WHEN failed THEN 'FAILED' WHEN killed THEN 'KILLED' "
                    "ELSE 'SUCCESS' END",
                ),
                "failed": ("boolean", "failed"),
                "failureReason": (
                    "string",
                    "CASE WHEN failed THEN 'java.lang.IllegalStateException: ' || exception || "
                    "chr(10) || chr(9) || 'at Job.run' "
                    "WHEN killed THEN 'TaskKilled (another attempt succeeded)' ELSE '' END",
                ),
                "speculative": ("boolean", "speculative"),
                "killed": ("boolean", "killed"),
                "finished": ("boolean", "NOT unfinished"),
                "executorId": ("string", "executor_id"),
                "duration": ("long", "CASE WHEN NOT unfinished THEN duration_ms END"),
                "successful": ("boolean", "NOT (unfinished OR failed OR killed)"),
                "host": ("string", "host"),
                "taskLocality": (
                    "int",
                    "CASE locality WHEN 'NODE_LOCAL' THEN 1 WHEN 'ANY' THEN 4 ELSE -1 END",
                ),
                **_task_counters(compat),
            },
            _FINISH,
            "NOT unfinished AND NOT without_metrics" if compat else "true",
        ),
    }
    return kinds


_TASK_KINDS = ("tasks_started", "tasks_ended", "task_metrics")
_FIXED = _kinds()
_COMPAT = _kinds(compat=True)
_BASIC = [kind for name, kind in _FIXED.items() if name not in _TASK_KINDS]


def _table(kind: Kind) -> str:
    columns = [f'{kind.key} AS "metricType"'] + [
        f'CAST({sql} AS {_SQL_TYPES[type_]}) AS "{name}"'
        for name, (type_, sql) in kind.entries.items()
    ]
    return kind.rows(", ".join(columns))


def _json(kind: Kind, pretty: bool = False) -> str:
    colon, gap, end = (" : ", "chr(10) || '  ", "chr(10) || ") if pretty else (":", "'", "")
    members = [
        f"{gap}\"{name}\"{colon}' || coalesce(CAST(to_json(CAST({sql} AS {_SQL_TYPES[type_]})) "
        "AS VARCHAR), 'null')"
        for name, (type_, sql) in kind.entries.items()
    ]
    return "'{' || " + " || ',' || ".join(members) + f" || {end}'}}'"


def _record_rows(kind: Kind) -> str:
    return kind.rows(
        f"{kind.key} AS \"metricType\", '{kind.name}' AS name, app_id AS \"appId\", "
        f'CAST({kind.time} AS BIGINT) AS "epochMillis", {_json(kind)} AS payload'
    )


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _numbers(kind: Kind, types: tuple[str, ...]) -> dict[str, str]:
    """Sample name -> value of the entries that are numbers for Prometheus, in name order."""
    return {
        name.lower(): sql
        for name, (type_, sql) in sorted(kind.entries.items(), key=lambda e: e[0].lower())
        if type_ in types
    }


def _sample_rows(kind: Kind, types: tuple[str, ...] = ("long",)) -> str:
    samples = ", ".join(
        f"{{'metric': '{name}', 'value': CAST({sql} AS BIGINT)}}"
        for name, sql in _numbers(kind, types).items()
    )
    inner = kind.rows(
        f"{kind.key} AS type, app_id AS appid, unnest([{samples}]) AS sample, "
        f'CAST({kind.time} AS BIGINT) AS "epochMillis"'
    )
    return (
        f"SELECT '{JOB}' AS job, '{INSTANCE}' AS instance, type, appid, "
        'sample.metric AS metric, sample.value AS value, "epochMillis" '
        f"FROM ({inner}) WHERE sample.value IS NOT NULL"
    )


def _text_rows(kind: Kind) -> str:
    lines = ", ".join(
        f"'{name} ' || CAST(CAST({sql} AS BIGINT) AS VARCHAR)"
        for name, sql in _numbers(kind, ("long",)).items()
    )
    return kind.rows(
        f"{kind.key} AS type, app_id AS appid, concat_ws(chr(10), {lines}) || chr(10) AS text"
    )


_WORDS = r"""SELECT lower(word) AS word, count(*) AS count FROM (
    SELECT unnest(string_split_regex(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)
    WHERE length(word) > 1 GROUP BY 1"""

_SAMPLES = _union([_sample_rows(kind) for kind in _BASIC])
_TEXTS = _union([_text_rows(kind) for kind in _BASIC])
_RECORDS = _union([_record_rows(kind) for kind in _FIXED.values()])

_SQL_EVENT = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
_COUNT_PARTS = [
    ("SparkListenerTaskStart", "lineitem"),
    ("SparkListenerTaskEnd", "lineitem"),
    ("SparkListenerStageSubmitted", "(SELECT DISTINCT l_suppkey FROM lineitem)"),
    ("SparkListenerStageCompleted", "(SELECT DISTINCT l_suppkey FROM lineitem)"),
    ("SparkListenerJobStart", "orders"),
    ("SparkListenerJobEnd", "orders"),
    ("SparkListenerExecutorAdded", "supplier"),
    ("SparkListenerExecutorRemoved", "supplier"),
    ("org.apache.spark.scheduler.SparkListenerExecutorExcluded", "supplier"),
    (f"{_SQL_EVENT}Start", "events"),
    (f"{_SQL_EVENT}End", "events"),
    ("SparkListenerApplicationStart", "customer"),
    ("SparkListenerApplicationEnd", "customer"),
]
_COUNTS = _union(
    [
        f"SELECT '{event}' AS event, count(*) AS events, true AS recorded FROM {relation}"
        for event, relation in _COUNT_PARTS
    ]
    + [
        "SELECT 'SparkListenerBlockManagerAdded' AS event, count(*) AS events, "
        "false AS recorded FROM nation"
    ]
)

_APPLICATIONS = f"""
SELECT 'application_started' AS name, app_name AS "appName",
    coalesce(app_id, 'noAppId') AS "appId", time_ms AS time, "user" AS "sparkUser",
    coalesce(attempt, 'N/A') AS "appAttemptId",
    concat('Spark application started, Application Name: ', app_name, ', Application ID: ',
        coalesce(app_id, 'noAppId'), ', Time: ', time_ms, ', Spark User: ', "user",
        ', App Attempt ID: ', coalesce(attempt, 'N/A')) AS message
FROM ({_INPUTS["app"]})
UNION ALL
SELECT 'application_ended', NULL, log_app, time_ms, NULL, NULL,
    concat('Spark application ended, timestamp = ', time_ms)
FROM ({_INPUTS["app"]})"""

_ROLLUP = f"""
SELECT app_id AS "appId", CAST(stage_id AS BIGINT) AS "stageId",
    CAST(stage_attempt AS INTEGER) AS "stageAttempt", count(*) AS tasks,
    {", ".join(
        f"CAST(coalesce(sum({_sum(paths)}) FILTER (NOT without_metrics), 0) AS BIGINT) "
        f'AS "{name}"' for name, paths in _PATHS.items())}
FROM ({_INPUTS["task"]}) GROUP BY 1, 2, 3"""

_LATEST = """
SELECT user_id, event_type, arg_max(value, (epoch_us(ts), event_id)) AS value
FROM events GROUP BY user_id, event_type"""
_LATEST_FULL = """
SELECT user_id, event_type, newest.value AS value, newest.micros AS micros,
    newest.event_id AS event_id
FROM (SELECT user_id, event_type, arg_max(
        {'value': value, 'micros': epoch_us(ts), 'event_id': event_id},
        (epoch_us(ts), event_id)) AS newest
    FROM events GROUP BY user_id, event_type)"""


def _scrapes(every_ms: int) -> str:
    return f"""
SELECT user_id, event_type, (epoch_us(ts) // {every_ms * 1000} + 1) * {every_ms} AS "scrapeMillis",
    arg_max(value, (epoch_us(ts), event_id)) AS value
FROM events GROUP BY 1, 2, 3"""


def _sanitized(valid: str) -> str:
    raw = _union(
        [
            f"SELECT '{column}' AS source, {column} AS raw FROM {table}"
            for table, column in (
                ("part", "p_brand"),
                ("part", "p_name"),
                ("part", "p_type"),
                ("pages", "url"),
            )
        ]
    )
    return f"""
SELECT source, raw, replace(
    CASE WHEN regexp_matches(words, '^[0-9]') THEN '_' || words ELSE words END, ' ', '_') AS clean
FROM (SELECT source, raw, trim(regexp_replace(raw, '[^{valid}]', ' ', 'g')) AS words FROM ({raw}))"""


_PUSH_STATE = f"""
SELECT job, instance, type, appid, metric, arg_max(value, ("epochMillis", value)) AS value,
    max("epochMillis") AS "epochMillis"
FROM ({_SAMPLES}) GROUP BY ALL"""

_INTERVALS = f"""
SELECT user_id, event_type, value, "scrapeMillis" AS "firstMillis",
    lead("scrapeMillis") OVER series - 500 AS "lastMillis"
FROM (SELECT *, lag(value) OVER earlier AS before, row_number() OVER earlier AS turn
    FROM ({_scrapes(500)})
    WINDOW earlier AS (PARTITION BY user_id, event_type ORDER BY "scrapeMillis"))
WHERE turn = 1 OR before IS DISTINCT FROM value
WINDOW series AS (PARTITION BY user_id, event_type ORDER BY "scrapeMillis")"""

# The lines that Java prints for the frames of `table_logs.FRAMES`.
_FRAMES = """list_slice([
        concat('        job.Part', l_partkey % 10, '.read(Part.scala:', l_linenumber * 10, ')'),
        '        jdk.internal.Unsafe.park(Native Method)',
        concat('        job.Generated', l_suppkey, '.apply(Unknown Source)'),
        '        job.Main$.main(Main.scala)'
    ], 1, l_orderkey % 5)"""
_FAILURES = f"""
SELECT task_id AS "taskId", attempt AS "attemptNumber", 'FAILED' AS status,
    coalesce(full_trace, concat('java.io.IOException: ', coalesce(description, ''), chr(10),
        coalesce(array_to_string({_FRAMES}, chr(10)), ''))) AS "failureReason"
FROM (SELECT *, {", ".join(f"{sql} AS {name}" for name, sql in logs.FAILED_TASK.items())}
    FROM {_ITEMS} WHERE l_returnflag = 'R')"""


ORACLES: dict[str, str] = {
    "word_count": _WORDS,
    "word_count_top": f"SELECT * FROM ({_WORDS}) ORDER BY count DESC, word LIMIT 20",
    "word_count_roundtrip": _WORDS,
    "event_log_counts": _COUNTS,
    **{name: _table(kind) for name, kind in _FIXED.items()},
    **{
        f"{name}_compat": _table(_COMPAT[name])
        for name in ("stage_metrics", "jobs_ended", "tasks_ended", "task_metrics")
    },
    "application_records": _APPLICATIONS,
    "records_basic": _union([_record_rows(kind) for kind in _BASIC]),
    "records_extended": _RECORDS,
    "records_compat": _union([_record_rows(kind) for kind in _COMPAT.values()]),
    "stage_rollup": _ROLLUP,
    "prometheus_samples": _SAMPLES,
    "prometheus_samples_all": _union([_sample_rows(kind, ("long", "int")) for kind in _BASIC]),
    "exposition_text": _TEXTS,
    "exposition_text_extended": _union([_text_rows(kind) for kind in _FIXED.values()]),
    "push_requests": f"""
SELECT 'http://{GATEWAY}/metrics/job/{JOB}/instance/{INSTANCE}/type/' || type || '/appid/' || appid
    AS url, 'text/plain' AS content_type, text AS body FROM ({_TEXTS})""",
    "kafka_rows": _union(
        [kind.rows(f"false AS keyed, {_json(kind, pretty=True)} AS value") for kind in _BASIC]
    ),
    "latest_samples": _LATEST_FULL,
    "latest_push_state": _PUSH_STATE,
    "scrape_samples": _scrapes(500),
    "scrape_samples_15s": _scrapes(15000),
    "value_intervals": _INTERVALS,
    "task_failures": _FAILURES,
    "sanitize_metric_name": _sanitized("a-zA-Z0-9_:"),
    "sanitize_label_name": _sanitized("a-zA-Z0-9_"),
    "event_files_records": _RECORDS,
    "event_files_rollup": _ROLLUP,
    "event_files_counts": _COUNTS,
    "text_files_word_count": _WORDS,
    "event_stream_records": _RECORDS,
    "event_tail_records": _union([_record_rows(kind) for kind in _BASIC]),
    "latest_samples_stream": _LATEST,
    "latest_push_state_stream": _PUSH_STATE,
    "scrape_samples_stream": _scrapes(15000),
}
