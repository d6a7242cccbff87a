"""Fields a record derives from task and job information, as SQL text.

Record kinds are rendered as one SQL expression each: building thousands of
Column nodes one call at a time would take longer than running many a query.
Arguments are SQL expressions of the struct or field.
"""

from __future__ import annotations

# Locality level codes; every other level is -1.
LOCALITY_CODES = {
    "PROCESS_LOCAL": 0,
    "NODE_LOCAL": 1,
    "RACK_LOCAL": 2,
    "NO_PREF": 3,
    "ANY": 4,
}


def task_locality_code(locality: str) -> str:
    levels = " ".join(f"WHEN '{level}' THEN {code}" for level, code in LOCALITY_CODES.items())
    return f"CASE {locality} {levels} ELSE -1 END"


def task_finished(info: str) -> str:
    return f"(coalesce({info}.`Finish Time`, 0) != 0)"


def task_successful(info: str) -> str:
    return (
        f"({task_finished(info)} AND NOT coalesce({info}.Failed, false)"
        f" AND NOT coalesce({info}.Killed, false))"
    )


def task_duration(info: str) -> str:
    """Finish minus launch; null while the task is running."""
    elapsed = f"{info}.`Finish Time` - {info}.`Launch Time`"
    return f"CASE WHEN {task_finished(info)} THEN {elapsed} END"


def task_status(info: str) -> str:
    return f"""CASE
        WHEN NOT {task_finished(info)} THEN
            IF(coalesce({info}.`Getting Result Time`, 0) != 0, 'GET RESULT', 'RUNNING')
        WHEN {info}.Failed THEN 'FAILED'
        WHEN {info}.Killed THEN 'KILLED'
        ELSE 'SUCCESS' END"""


def frames_text(frames: str) -> str:
    """A line per stack frame, as Java words a frame: ``Class.method(File:line)``.

    Line -2 marks native code; other negative ones and missing files are unknown places.
    """
    place = """CASE WHEN f.`Line Number` = -2 THEN 'Native Method'
        WHEN f.`File Name` IS NULL THEN 'Unknown Source'
        WHEN f.`Line Number` >= 0 THEN concat(f.`File Name`, ':', f.`Line Number`)
        ELSE f.`File Name` END"""
    frame = f"concat('        ', f.`Declaring Class`, '.', f.`Method Name`, '(', {place}, ')')"
    return f"array_join(transform({frames}, f -> {frame}), '\\n')"


def failure_text(reason: str) -> str:
    """Error text of a `Task End Reason`, worded as Spark words it; '' on success.

    An exception is its full trace; without one, class, description and the lines of its frames.
    """
    manager = f"{reason}.`Block Manager Address`"
    return f"""CASE coalesce({reason}.Reason, 'Success')
        WHEN 'Success' THEN ''
        WHEN 'ExceptionFailure' THEN coalesce(
            {reason}.`Full Stack Trace`,
            concat({reason}.`Class Name`, ': ', coalesce({reason}.Description, ''), '\\n',
                {frames_text(f"{reason}.`Stack Trace`")}),
            concat_ws(': ', {reason}.`Class Name`, {reason}.Description))
        WHEN 'FetchFailed' THEN concat(
            'FetchFailed(',
            IF({manager} IS NULL, 'null', format_string('BlockManagerId(%s, %s, %d, None)',
                {manager}.`Executor ID`, {manager}.Host, {manager}.Port)),
            format_string(', shuffleId=%d, mapIndex=%d, mapId=%d, reduceId=%d, message=\\n%s\\n)',
                {reason}.`Shuffle ID`, {reason}.`Map Index`, {reason}.`Map ID`,
                {reason}.`Reduce ID`, coalesce({reason}.Message, 'Unknown reason')))
        WHEN 'ExecutorLostFailure' THEN concat(
            'ExecutorLostFailure (executor ', coalesce({reason}.`Executor ID`, 'null'),
            IF(coalesce({reason}.`Exit Caused By App`, true),
                ' exited caused by one of the running tasks)',
                ' exited unrelated to the running tasks)'),
            coalesce(concat(' Reason: ', {reason}.`Loss Reason`), ''))
        WHEN 'TaskKilled' THEN concat(
            'TaskKilled (', coalesce({reason}.`Kill Reason`, 'unknown reason'), ')')
        WHEN 'TaskCommitDenied' THEN format_string(
            'TaskCommitDenied (Driver denied task commit) for job: %d, partition: %d, '
            'attemptNumber: %d',
            {reason}.`Job ID`, {reason}.`Partition ID`, {reason}.`Attempt Number`)
        WHEN 'Resubmitted' THEN 'Resubmitted (resubmitted due to lost executor)'
        WHEN 'TaskResultLost' THEN 'TaskResultLost (result lost from block manager)'
        ELSE {reason}.Reason END"""


def job_result_text(result: str, compat: bool = False) -> str:
    """``Succeeded`` or ``Failed: <message>``.

    A log keeps the message of the failure but not its class.  ``compat`` words
    it as a Spark 3 listener sees it, where that class is SparkException.
    """
    message = f"coalesce({result}.Exception.Message, {result}.Result, '')"
    if compat:
        message = f"concat('JobFailed(org.apache.spark.SparkException: ', {message}, ')')"
    return f"IF({result}.Result = 'JobSucceeded', 'Succeeded', concat('Failed: ', {message}))"
