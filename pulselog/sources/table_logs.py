"""Event-log lines derived from ordinary tables.

The supplied test tables hold no listener events, so each table is mapped to the
lines Spark would have logged for such activity: line items are tasks, suppliers
stages and executors, orders jobs, `events` SQL executions, customers
applications.  Every binding is a plain projection (one aggregation for stages)
over the whole table, yields ``(value, appId)`` and feeds the real parser.

The expressions in the dictionaries are portable SQL: the checks evaluate the
same inputs in another engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselog import schema
from pulselog.functions.order import epoch_millis

# Independent task counters of a line item; the derived totals follow from them.
# Distinct multipliers make a mix-up of two counters show.
TASK_COUNTERS = {
    "Executor Run Time": "CAST(floor(l_quantity) AS BIGINT)",
    "Executor CPU Time": "2 * CAST(floor(l_quantity) AS BIGINT)",
    "Executor Deserialize CPU Time": "(l_partkey * 3 + l_linenumber) % 997",
    "Executor Deserialize Time": "(l_partkey * 5 + l_linenumber) % 997",
    "JVM GC Time": "(l_partkey * 7 + l_linenumber) % 997",
    "Memory Bytes Spilled": "CAST(0 AS BIGINT)",
    "Peak Execution Memory": "(l_partkey * 11 + l_orderkey) % 65536",
    "Result Serialization Time": "(l_partkey * 13 + l_linenumber) % 97",
    "Result Size": "(l_partkey * 17 + l_orderkey) % 4096",
    "Input Metrics.Bytes Read": "CAST(floor(l_extendedprice) AS BIGINT)",
    "Input Metrics.Records Read": "(l_orderkey * 19 + l_linenumber) % 997",
    "Output Metrics.Bytes Written": "(l_orderkey * 23 + l_partkey) % 9973",
    "Output Metrics.Records Written": "(l_orderkey * 29 + l_partkey) % 997",
    "Shuffle Read Metrics.Remote Bytes Read": "l_partkey",
    "Shuffle Read Metrics.Local Bytes Read": "l_orderkey",
    "Shuffle Read Metrics.Remote Bytes Read To Disk": "(l_orderkey * 31) % 101",
    "Shuffle Read Metrics.Local Blocks Fetched": "(l_orderkey * 37) % 103",
    "Shuffle Read Metrics.Remote Blocks Fetched": "(l_orderkey * 41) % 107",
    "Shuffle Read Metrics.Total Records Read": "(l_orderkey * 43) % 109",
    "Shuffle Read Metrics.Fetch Wait Time": "(l_orderkey * 47) % 113",
    "Shuffle Write Metrics.Shuffle Bytes Written": "(l_partkey * 53) % 127",
    "Shuffle Write Metrics.Shuffle Records Written": "(l_partkey * 59) % 131",
    "Shuffle Write Metrics.Shuffle Write Time": "(l_partkey * 61) % 137",
}

# The accumulator of each. Not taken from the engine's list, so that a mix-up there
# shows.
ACCUMULATORS = {
    "Executor Run Time": "internal.metrics.executorRunTime",
    "Executor CPU Time": "internal.metrics.executorCpuTime",
    "Executor Deserialize CPU Time": "internal.metrics.executorDeserializeCpuTime",
    "Executor Deserialize Time": "internal.metrics.executorDeserializeTime",
    "JVM GC Time": "internal.metrics.jvmGCTime",
    "Memory Bytes Spilled": "internal.metrics.memoryBytesSpilled",
    "Peak Execution Memory": "internal.metrics.peakExecutionMemory",
    "Result Serialization Time": "internal.metrics.resultSerializationTime",
    "Result Size": "internal.metrics.resultSize",
    "Input Metrics.Bytes Read": "internal.metrics.input.bytesRead",
    "Input Metrics.Records Read": "internal.metrics.input.recordsRead",
    "Output Metrics.Bytes Written": "internal.metrics.output.bytesWritten",
    "Output Metrics.Records Written": "internal.metrics.output.recordsWritten",
    "Shuffle Read Metrics.Remote Bytes Read": "internal.metrics.shuffle.read.remoteBytesRead",
    "Shuffle Read Metrics.Local Bytes Read": "internal.metrics.shuffle.read.localBytesRead",
    "Shuffle Read Metrics.Remote Bytes Read To Disk": (
        "internal.metrics.shuffle.read.remoteBytesReadToDisk"
    ),
    "Shuffle Read Metrics.Local Blocks Fetched": "internal.metrics.shuffle.read.localBlocksFetched",
    "Shuffle Read Metrics.Remote Blocks Fetched": (
        "internal.metrics.shuffle.read.remoteBlocksFetched"
    ),
    "Shuffle Read Metrics.Total Records Read": "internal.metrics.shuffle.read.recordsRead",
    "Shuffle Read Metrics.Fetch Wait Time": "internal.metrics.shuffle.read.fetchWaitTime",
    "Shuffle Write Metrics.Shuffle Bytes Written": "internal.metrics.shuffle.write.bytesWritten",
    "Shuffle Write Metrics.Shuffle Records Written": (
        "internal.metrics.shuffle.write.recordsWritten"
    ),
    "Shuffle Write Metrics.Shuffle Write Time": "internal.metrics.shuffle.write.writeTime",
}

# `ship_ms` stands for the epoch milliseconds of l_shipdate.
TASK = {
    "app_id": "concat('app-', l_suppkey % 4)",
    "stage_id": "l_suppkey",
    "stage_attempt": "CAST(0 AS INTEGER)",
    "task_id": "l_orderkey * 10 + l_linenumber",
    "attempt": "l_linenumber",
    "launch_ms": "ship_ms",
    "unfinished": "l_linenumber = 5 AND l_orderkey % 10 = 0",
    "duration_ms": "CAST(floor(l_extendedprice) AS BIGINT)",
    "getting_result_ms": "CASE WHEN l_orderkey % 20 = 0 THEN ship_ms + 1 ELSE CAST(0 AS BIGINT) END",
    "executor_id": "CAST(l_partkey % 16 AS VARCHAR(20))",
    "host": "concat('host-', l_partkey % 8)",
    "locality": "CASE l_returnflag WHEN 'A' THEN 'NODE_LOCAL' WHEN 'N' THEN 'ANY' ELSE 'MOON' END",
    "speculative": "l_linenumber = 6",
    "failed": "l_returnflag = 'R'",
    "killed": "l_returnflag = 'A' AND l_linenumber = 7",
    "without_metrics": "l_linenumber = 4 AND l_orderkey % 50 = 0",
    "exception": "concat('part ', l_partkey)",
}

STAGE = {
    "app_id": "concat('app-', l_suppkey % 4)",
    "no_submission": "l_suppkey % 10 = 0",
    "failure": "CASE WHEN l_suppkey % 7 = 0 THEN concat('stage lost \"', l_suppkey, '\"') END",
}

# `order_ms` stands for the epoch milliseconds of o_orderdate.
JOB = {
    "app_id": "concat('app-', o_orderkey % 4)",
    "job_id": "o_orderkey",
    "start_ms": "order_ms",
    "end_ms": "order_ms + CAST(floor(o_totalprice) AS BIGINT)",
    "failed": "o_orderstatus = 'F'",
    "message": "o_orderpriority",
}

EXECUTOR = {
    "app_id": "concat('app-', s_suppkey % 4)",
    "executor_id": "CAST(s_suppkey AS VARCHAR(20))",
    "time_ms": "s_suppkey * 1000",
    "host": "s_name",
    "cores": "s_nationkey",
    "reason": "s_name",
    "failures": "s_nationkey",
}

# `event_ms` stands for the epoch milliseconds of ts.
SQL = {
    "app_id": "concat('app-', event_id % 4)",
    "query_id": "event_id",
    "description": "event_type",
    "start_ms": "event_ms",
    "end_ms": "event_ms + CAST(floor(value) AS BIGINT)",
}

APPLICATION = {
    "log_app": "concat('app-', c_custkey)",
    "app_name": "c_name",
    "app_id": "CASE WHEN c_custkey % 5 <> 0 THEN concat('app-', c_custkey) END",
    "attempt": "CASE WHEN c_custkey % 3 = 0 THEN '1' END",
    "user": "c_mktsegment",
    "time_ms": "c_custkey * 1000",
}

BLOCK_MANAGER = {"app_id": "'app-0'", "host": "n_name", "time_ms": "n_nationkey * 1000"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables, a file or a folder of files, taken as it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _inputs(table: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return table.selectExpr(*[f"{sql} AS `{name}`" for name, sql in expressions.items()])


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def _line(event: str, fields: dict[str, str]) -> str:
    return f"to_json({_struct({'Event': repr(event), **fields})})"


def _lines(rows: DataFrame, *lines: str, app: str = "app_id") -> DataFrame:
    """All lines of a row from one scan of the table.

    The texts are built in a projection below the generator (kept there by
    explode_outer, see ``each_record``), where they are generated code in any plan.
    """
    texts = rows.selectExpr(f"array({', '.join(lines)}) AS _lines", f"{app} AS appId")
    return texts.select(F.explode_outer("_lines").alias("value"), "appId")


def _nested(paths) -> str:
    """Struct with one level of nesting, a member per dotted path, valued by the column so named."""
    groups: dict[str, dict[str, str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        groups.setdefault(head, {})[rest] = f"`{path}`"
    return _struct(
        {head: inner[""] if "" in inner else _struct(inner) for head, inner in groups.items()}
    )


def _with_millis(table: DataFrame, name: str, timestamp: str) -> DataFrame:
    return table.withColumn(name, epoch_millis(F.col(timestamp)))


def task_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task start and a task end per line item."""
    items = _with_millis(read_table(spark, sf_dir, "lineitem"), "ship_ms", "l_shipdate")

    def info(finish: str, getting_result: str, failed: str, killed: str) -> str:
        return _struct(
            {
                "Task ID": "task_id",
                "Index": "attempt",
                "Attempt": "attempt",
                "Launch Time": "launch_ms",
                "Executor ID": "executor_id",
                "Host": "host",
                "Locality": "locality",
                "Speculative": "speculative",
                "Getting Result Time": getting_result,
                "Finish Time": finish,
                "Failed": failed,
                "Killed": killed,
            }
        )

    finish = "IF(unfinished, 0L, launch_ms + duration_ms)"
    reason = _struct(
        {
            "Reason": "CASE WHEN failed THEN 'ExceptionFailure' WHEN killed THEN 'TaskKilled' "
            "ELSE 'Success' END",
            "Class Name": "IF(failed, 'java.lang.IllegalStateException', NULL)",
            "Description": "IF(failed, exception, NULL)",
            "Full Stack Trace": "IF(failed, concat("
            "'java.lang.IllegalStateException: ', exception, '\\n\\tat Job.run'), NULL)",
            "Kill Reason": "IF(killed, 'another attempt succeeded', NULL)",
        }
    )
    stage = {"Stage ID": "stage_id", "Stage Attempt ID": "stage_attempt"}
    return _lines(
        _inputs(items, {**TASK, **TASK_COUNTERS}),
        _line(schema.TASK_START, {**stage, "Task Info": info("0L", "0L", "false", "false")}),
        _line(
            schema.TASK_END,
            {
                **stage,
                "Task Type": "'ResultTask'",
                "Task End Reason": reason,
                "Task Info": info(finish, "getting_result_ms", "failed", "killed"),
                "Task Metrics": f"IF(without_metrics, NULL, {_nested(TASK_COUNTERS)})",
            },
        ),
    )


# Frames of a failed task: declaring class, method, file and line as SQL of a line item.
FRAMES = (
    ("concat('job.Part', l_partkey % 10)", "'read'", "'Part.scala'", "l_linenumber * 10"),
    ("'jdk.internal.Unsafe'", "'park'", "'Unsafe.java'", "-2"),
    ("concat('job.Generated', l_suppkey)", "'apply'", "CAST(NULL AS VARCHAR(20))", "-1"),
    ("'job.Main$'", "'main'", "'Main.scala'", "-1"),
)

FAILED_TASK = {
    "task_id": TASK["task_id"],
    "attempt": TASK["attempt"],
    "launch_ms": "ship_ms",
    "finish_ms": "ship_ms + 1 + CAST(floor(l_quantity) AS BIGINT)",
    "description": "CASE WHEN l_linenumber % 3 <> 0 THEN concat('part \"', l_partkey, '\"') END",
    "full_trace": "CASE WHEN l_partkey % 4 = 0 THEN concat('E: full', chr(10), l_partkey) END",
    "n_frames": "l_orderkey % 5",
}


def failed_task_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed task per returned line item; most were logged with frames and no full trace."""
    items = _with_millis(read_table(spark, sf_dir, "lineitem"), "ship_ms", "l_shipdate")
    names = ("Declaring Class", "Method Name", "File Name", "Line Number")
    frames = ", ".join(_struct(dict(zip(names, frame))) for frame in FRAMES)
    inputs = {**FAILED_TASK, "frames": f"slice(array({frames}), 1, CAST(l_orderkey % 5 AS INT))"}
    reason = {
        "Reason": "'ExceptionFailure'",
        "Class Name": "'java.io.IOException'",
        "Description": "description",
        "Stack Trace": "frames",
        "Full Stack Trace": "full_trace",
    }
    info = {
        "Task ID": "task_id",
        "Attempt": "attempt",
        "Launch Time": "launch_ms",
        "Finish Time": "finish_ms",
        "Failed": "true",
        "Killed": "false",
    }
    counters = {"Task Metrics": _struct({"Executor Run Time": "1L"})}
    return _lines(
        _inputs(items.where("l_returnflag = 'R'"), inputs).withColumn("app_id", F.lit("app-0")),
        _line(
            schema.TASK_END,
            {"Stage ID": "0L", "Stage Attempt ID": "0", "Task End Reason": _struct(reason)}
            | {"Task Info": _struct(info)}
            | counters,
        ),
    )


def stage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage submission and a stage completion per supplier that occurs in line items."""
    items = _with_millis(read_table(spark, sf_dir, "lineitem"), "ship_ms", "l_shipdate")
    inputs = {"ship_ms": "ship_ms", "l_suppkey": "l_suppkey", **TASK_COUNTERS}
    stages = (
        _inputs(items, inputs)
        .groupBy("l_suppkey")
        .agg(
            F.min("ship_ms").alias("submitted"),
            F.max("ship_ms").alias("completed"),
            F.expr("CAST(count(*) AS int) AS tasks"),
            *[F.expr(f"sum(`{path}`) AS `{path}`") for path in TASK_COUNTERS],
        )
    )
    totals = ", ".join(
        _struct({"Name": f"'{ACCUMULATORS[path]}'", "Value": f"`{path}`"})
        for path in TASK_COUNTERS
    )
    identity = {
        "Stage ID": "l_suppkey",
        "Stage Attempt ID": "0",
        "Stage Name": "'stage'",
        "Number of Tasks": "tasks",
        "Submission Time": "IF(no_submission, NULL, submitted)",
    }
    outcome = {
        "Completion Time": "completed",
        "Failure Reason": "failure",
        "Accumulables": f"filter(array({totals}), a -> a.Value != 0)",
    }
    return _lines(
        stages.selectExpr("*", *[f"{sql} AS {name}" for name, sql in STAGE.items()]),
        _line(schema.STAGE_SUBMITTED, {"Stage Info": _struct(identity)}),
        _line(schema.STAGE_COMPLETED, {"Stage Info": _struct({**identity, **outcome})}),
    )


def job_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job start and a job end per order."""
    orders = _with_millis(read_table(spark, sf_dir, "orders"), "order_ms", "o_orderdate")
    result = _struct(
        {
            "Result": "IF(failed, 'JobFailed', 'JobSucceeded')",
            "Exception": f"IF(failed, {_struct({'Message': 'message'})}, NULL)",
        }
    )
    job = {"Job ID": "job_id"}
    return _lines(
        _inputs(orders, JOB),
        _line(schema.JOB_START, {**job, "Submission Time": "start_ms"}),
        _line(schema.JOB_END, {**job, "Completion Time": "end_ms", "Job Result": result}),
    )


def executor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An executor added, removed and excluded per supplier."""
    executor = {"Timestamp": "time_ms", "Executor ID": "executor_id"}
    info = _struct({"Host": "host", "Total Cores": "cores"})
    excluded = {"time": "time_ms", "executorId": "executor_id", "taskFailures": "failures"}
    return _lines(
        _inputs(read_table(spark, sf_dir, "supplier"), EXECUTOR),
        _line(schema.EXECUTOR_ADDED, {**executor, "Executor Info": info}),
        _line(schema.EXECUTOR_REMOVED, {**executor, "Removed Reason": "reason"}),
        _line(schema.EXECUTOR_EXCLUDED, excluded),
    )


def sql_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL execution start and end per row of `events`."""
    events = _with_millis(read_table(spark, sf_dir, "events"), "event_ms", "ts")
    query = {"executionId": "query_id"}
    return _lines(
        _inputs(events, SQL),
        _line(schema.SQL_START, {**query, "description": "description", "time": "start_ms"}),
        _line(schema.SQL_END, {**query, "time": "end_ms"}),
    )


def application_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An application start and end per customer."""
    start = {
        "App Name": "app_name",
        "App ID": "app_id",
        "Timestamp": "time_ms",
        "User": "user",
        "App Attempt ID": "attempt",
    }
    return _lines(
        _inputs(read_table(spark, sf_dir, "customer"), APPLICATION),
        _line(schema.APPLICATION_START, {name: f"`{column}`" for name, column in start.items()}),
        _line(schema.APPLICATION_END, {"Timestamp": "time_ms"}),
        app="log_app",
    )


def block_manager_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event without a record per nation."""
    manager = _struct({"Executor ID": "'driver'", "Host": "host", "Port": "7000"})
    return _lines(
        _inputs(read_table(spark, sf_dir, "nation"), BLOCK_MANAGER),
        _line(
            "SparkListenerBlockManagerAdded",
            {"Block Manager ID": manager, "Maximum Memory": "1", "Timestamp": "time_ms"},
        ),
    )


def basic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that yields a record without extended mode."""
    parts = (stage_lines, job_lines, executor_lines, sql_lines)
    return reduce(DataFrame.union, [part(spark, sf_dir) for part in parts])


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log: all bindings."""
    parts = (task_lines, basic_lines, application_lines, block_manager_lines)
    return reduce(DataFrame.union, [part(spark, sf_dir) for part in parts])
