"""The named queries: every operator over whole supplied tables.

Queries on listener events run the real path: tables become event-log lines
(``sources.table_logs``), the lines are parsed, the operator does the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselog import operators as ops
from pulselog import schema, streaming
from pulselog.functions import (
    epoch_micros,
    epoch_millis,
    sanitize_label_name,
    sanitize_metric_name,
)
from pulselog.session import configured, scratch_dir, tune
from pulselog.sinks import write_json
from pulselog.sources import (
    parse_events,
    read_event_stream,
    read_events,
    read_lines,
    tail_lines,
)
from pulselog.sources import table_logs as logs
from pulselog.sources.replay import FILE_ROWS, Replay, ordered_copy, plan_replay, read_replay
from pulselog.sources.table_logs import read_table

Query = Callable[[SparkSession, str], DataFrame]

JOB = "telemetry"
GATEWAY = "gateway:9091"
SERIES = ("user_id", "event_type")
# Log files of one batch at least, and for each core: tasks of a batch come in whole rounds.
LOG_FILES_PER_BATCH = 16
LOG_FILES_PER_CORE = 2
# Lines of a sealed log file at most, and files that a task of its writer holds open.
LOG_FILE_LINES = 500_000
OPEN_FILES = 64
# Table bytes of a task of that writer: as text they are a hundred times as many.
SPLIT = "16m"
# Replays run in the order of event times, so a short delay drops nothing and bounds the state.
REPLAY_DELAY = "1 minute"
REPLAY_FILES = 4
# Samples of an order or event, about; files of one batch at most; entities that share push state.
ENTITY_SAMPLES = 6
REPLAY_FILES_PER_BATCH = 4
BUCKET_ENTITIES = 4096

# Record kind -> the lines it occurs in.
_LINES = {
    "stages_started": logs.stage_lines,
    "stages_ended": logs.stage_lines,
    "stage_metrics": logs.stage_lines,
    "executor_added": logs.executor_lines,
    "executor_removed": logs.executor_lines,
    "executor_excluded": logs.executor_lines,
    "queries_started": logs.sql_lines,
    "queries_ended": logs.sql_lines,
    "jobs_started": logs.job_lines,
    "jobs_ended": logs.job_lines,
    "tasks_started": logs.task_lines,
    "tasks_ended": logs.task_lines,
    "task_metrics": logs.task_lines,
}


def _table_query(kind: str, compat: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = parse_events(_LINES[kind](spark, sf_dir), (kind,))
        return ops.record_table(events, kind, compat)

    return query


def _basic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(logs.basic_lines(spark, sf_dir), schema.BASIC_KINDS)


def _extended_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.task_lines(spark, sf_dir).union(logs.basic_lines(spark, sf_dir))


def _extended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(_extended_lines(spark, sf_dir), schema.EXTENDED_KINDS)


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.word_count(_document_lines(spark, sf_dir))


def word_count_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_words(_document_lines(spark, sf_dir))


def word_count_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "word-count")
    write_json(word_count(spark, sf_dir), path)
    return spark.read.schema("word string, count bigint").json(path)


def event_log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.event_log_counts(logs.all_lines(spark, sf_dir))


def application_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = logs.application_lines(spark, sf_dir)
    return ops.application_records(parse_events(lines, schema.APPLICATION_KINDS))


def records_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parse_events(logs.all_lines(spark, sf_dir), schema.BASIC_KINDS)
    return ops.records(events)


def records_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.records(_extended_events(spark, sf_dir), extended=True)


def records_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.records(_extended_events(spark, sf_dir), extended=True, compat=True)


def stage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.stage_rollup(parse_events(logs.task_lines(spark, sf_dir), ("stage_rollup",)))


def prometheus_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.prometheus_samples(_basic_events(spark, sf_dir), job=JOB)


def prometheus_samples_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Int entries count as numbers too."""
    return ops.prometheus_samples(_basic_events(spark, sf_dir), job=JOB, numeric="all")


def exposition_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.exposition_text(_basic_events(spark, sf_dir))


def exposition_text_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.exposition_text(_extended_events(spark, sf_dir), extended=True)


def push_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.push_requests(exposition_text(spark, sf_dir), GATEWAY, JOB)


def kafka_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.kafka_rows(_basic_events(spark, sf_dir))
    # Text instead of binary, so that engines can be compared.
    return rows.select(
        F.col("key").isNotNull().alias("keyed"), F.col("value").cast("string").alias("value")
    )


def _series(events: DataFrame) -> DataFrame:
    return events.select(
        *SERIES, "value", "ts", "event_id", epoch_micros(F.col("ts")).alias("micros")
    )


def latest_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _series(read_table(spark, sf_dir, "events"))
    return ops.latest_samples(series, SERIES, time="micros", tie="event_id")


def latest_push_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gateway holds after all executor, job and stage records have been pushed."""
    return ops.latest_samples(prometheus_samples(spark, sf_dir))


def _scrape_query(every: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        series = _series(read_table(spark, sf_dir, "events"))
        ticks = ops.scrape_samples(series, SERIES, "ts", "event_id", every=every)
        return ticks.select(*SERIES, epoch_millis(F.col("tick.end")).alias("scrapeMillis"), "value")

    return query


def value_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that a scrape sees, also between pushes, as one row for each change."""
    series = _series(read_table(spark, sf_dir, "events"))
    seen = ops.value_intervals(series, SERIES, "ts", "event_id")
    first, last = (epoch_millis(F.col(c)) for c in ("first_tick", "last_tick"))
    return seen.select(*SERIES, "value", first.alias("firstMillis"), last.alias("lastMillis"))


def task_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error texts of failed tasks whose exceptions were logged as frames, without full trace."""
    events = parse_events(logs.failed_task_lines(spark, sf_dir), ("task_metrics",))
    failed = ops.record_table(events, "task_metrics")
    return failed.select("taskId", "attemptNumber", "status", "failureReason")


def sanitize(function) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        part, pages = read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "pages")
        names = ", ".join(f"'{c}', {c}" for c in ("p_brand", "p_name", "p_type"))
        raw = part.selectExpr(f"stack(3, {names}) AS (source, raw)").union(
            pages.select(F.lit("url"), "url")
        )
        return raw.withColumn("clean", function(F.col("raw")))

    return query


def _written_log(spark: SparkSession, lines: DataFrame, level: str = "BEST_COMPRESSION") -> str:
    """The lines as sealed files per application, written where they arise: nothing is shuffled.

    A task holds a file open for each application instead of sorting its lines by application;
    beyond ``OPEN_FILES`` applications it sorts the rest. The default ``level`` of gzip takes half
    of the time and a twentieth more of disk.
    """
    log = scratch_dir(spark, "event-log")
    writer = lines.write.partitionBy("appId").option("maxRecordsPerFile", LOG_FILE_LINES)
    writer = writer.options(compression="gzip", **{"zlib.compress.level": level})
    with (
        configured(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES),
        configured(spark, "spark.sql.files.maxPartitionBytes", SPLIT),
    ):
        writer.text(log)
    return log


def event_files_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(
        spark, _written_log(spark, _extended_lines(spark, sf_dir)), schema.EXTENDED_KINDS
    )
    return ops.records(events, extended=True)


def event_files_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _written_log(spark, logs.task_lines(spark, sf_dir))
    return ops.stage_rollup(read_events(spark, log, ("stage_rollup",)))


def event_files_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_dir(spark, "event-log")
    logs.all_lines(spark, sf_dir).select("value").write.option("compression", "gzip").text(log)
    return ops.event_log_counts(read_lines(spark, log))


def text_files_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "texts")
    _document_lines(spark, sf_dir).where("value IS NOT NULL").write.text(path)
    return ops.word_count(read_lines(spark, path))


def event_stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the log as sealed files per application, then streams records from them."""
    out = scratch_dir(spark, "stream-records")
    log = _written_log(spark, _extended_lines(spark, sf_dir), "DEFAULT_COMPRESSION")
    files = max(LOG_FILES_PER_BATCH, LOG_FILES_PER_CORE * spark.sparkContext.defaultParallelism)
    events = read_event_stream(spark, log, schema.EXTENDED_KINDS, max_files_per_trigger=files)
    table = streaming.records_table(spark, out)
    records = ops.records(events, extended=True)
    streaming.stream_to(
        records, table, scratch_dir(spark, "checkpoint"), mode="append"
    ).awaitTermination()
    return table.read().drop("batch")


def event_tail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the log as plain files, then streams records from their byte ranges."""
    log = scratch_dir(spark, "event-log")
    logs.basic_lines(spark, sf_dir).select("value", "appId").write.partitionBy("appId").text(log)
    events = parse_events(tail_lines(spark, log), schema.BASIC_KINDS)
    table = streaming.records_table(spark, scratch_dir(spark, "tail-records"))
    streaming.stream_to(
        ops.records(events), table, scratch_dir(spark, "checkpoint"), mode="append"
    ).awaitTermination()
    return table.read().drop("batch")


def _event_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream in the order of its event times."""
    table = read_table(spark, sf_dir, "events")
    replay = plan_replay(spark, table, "ts", delay_micros=0, files=REPLAY_FILES)
    return _series(read_replay(spark, replay, table))


def latest_samples_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = streaming.recent_stream(
        _event_table_stream(spark, sf_dir), SERIES, "ts", "micros", "event_id", keep="7 days",
        delay=REPLAY_DELAY,
    )
    table = streaming.latest_table(spark, scratch_dir(spark, "latest"), SERIES, order="seq")
    streaming.stream_to(latest, table, scratch_dir(spark, "checkpoint")).awaitTermination()
    return table.read().select(*SERIES, "value")


def latest_push_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The push state by a stream whose state ends with the entities, in order of event times."""
    samples = prometheus_samples(spark, sf_dir).select(
        "*",
        F.timestamp_millis("epochMillis").alias("at"),
        streaming.push_entity(F.col("type")).alias("entity"),
    )
    path = scratch_dir(spark, "samples")
    # Files follow the rows; counting rows of tables reads no column.
    entities = sum(read_table(spark, sf_dir, name).count() for name in ("orders", "events"))
    wanted = max(REPLAY_FILES, -(-entities * ENTITY_SAMPLES // FILE_ROWS))
    files = ordered_copy(samples, "at", path, wanted).count()
    at_once = max(1, min(REPLAY_FILES_PER_BATCH, files // REPLAY_FILES))
    latest = streaming.closing_stream(
        read_replay(spark, Replay(path, files, 0), samples, at_once),
        F.col("at"),
        streaming.push_ended(F.col("type")),
        delay=REPLAY_DELAY,
        buckets=max(32, entities // BUCKET_ENTITIES),
    )
    table = streaming.latest_table(spark, scratch_dir(spark, "push-state"), ops.PUSH_GROUP)
    streaming.stream_to(latest, table, scratch_dir(spark, "checkpoint")).awaitTermination()
    return table.read().select(*ops.PUSH_GROUP, "value", "epochMillis")


def scrape_samples_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = streaming.scrape_stream(
        _event_table_stream(spark, sf_dir), SERIES, "ts", "event_id", every="15 seconds",
        delay=REPLAY_DELAY,
    ).select(*SERIES, F.unix_millis("tick.end").alias("scrapeMillis"), "value")
    keys = (*SERIES, "scrapeMillis")
    table = streaming.latest_table(spark, scratch_dir(spark, "scrapes"), keys)
    streaming.stream_to(ticks, table, scratch_dir(spark, "checkpoint")).awaitTermination()
    return table.read().select(*keys, "value")


# Queries whose log and result lie on disk at the same time: JSON texts take a quarter less at this level.
ZSTD_LEVELS = {"event_files_records": 9}


def _tuned(name: str, query: Query) -> Query:
    levels = [ZSTD_LEVELS[name]] if name in ZSTD_LEVELS else []
    return lambda spark, sf_dir: query(tune(spark, *levels), sf_dir)


QUERIES: dict[str, Query] = {
    name: _tuned(name, query)
    for name, query in {
        "word_count": word_count,
        "word_count_top": word_count_top,
        "word_count_roundtrip": word_count_roundtrip,
        "event_log_counts": event_log_counts,
        **{kind: _table_query(kind) for kind in _LINES},
        "stage_metrics_compat": _table_query("stage_metrics", compat=True),
        "jobs_ended_compat": _table_query("jobs_ended", compat=True),
        "tasks_ended_compat": _table_query("tasks_ended", compat=True),
        "task_metrics_compat": _table_query("task_metrics", compat=True),
        "application_records": application_records,
        "records_basic": records_basic,
        "records_extended": records_extended,
        "records_compat": records_compat,
        "stage_rollup": stage_rollup,
        "prometheus_samples": prometheus_samples,
        "prometheus_samples_all": prometheus_samples_all,
        "exposition_text": exposition_text,
        "exposition_text_extended": exposition_text_extended,
        "push_requests": push_requests,
        "kafka_rows": kafka_rows,
        "latest_samples": latest_samples,
        "latest_push_state": latest_push_state,
        "scrape_samples": _scrape_query("500 milliseconds"),
        "scrape_samples_15s": _scrape_query("15 seconds"),
        "value_intervals": value_intervals,
        "task_failures": task_failures,
        "sanitize_metric_name": sanitize(sanitize_metric_name),
        "sanitize_label_name": sanitize(sanitize_label_name),
        "event_files_records": event_files_records,
        "event_files_rollup": event_files_rollup,
        "event_files_counts": event_files_counts,
        "text_files_word_count": text_files_word_count,
        "event_stream_records": event_stream_records,
        "event_tail_records": event_tail_records,
        "latest_samples_stream": latest_samples_stream,
        "latest_push_state_stream": latest_push_state_stream,
        "scrape_samples_stream": scrape_samples_stream,
    }.items()
}
