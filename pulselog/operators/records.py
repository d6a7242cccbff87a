"""Typed record tables and the mixed record stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselog import schema
from pulselog.operators.catalogue import BASIC, TASK, Record, kind_record, with_stage_counters

RECORD_NAMES = schema.EXTENDED_KINDS


def record_table(events: DataFrame, kind: str, compat: bool = False) -> DataFrame:
    """The table of one record kind: metricType, name, appId, its fields, epochMillis."""
    rows = with_stage_counters(events) if kind == "stage_metrics" else events
    record = kind_record(kind, compat)
    return rows.where(f"Event = '{schema.KIND_EVENTS[kind]}' AND {record.present}").selectExpr(
        f"{record.metric_type} AS metricType",
        *[f"{field.value} AS {field.name}" for field in record.entries()],
    )


def each_record(
    events: DataFrame,
    render: Callable[[Record], str],
    extended: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Renders every record of every event in one pass; one struct per record, flattened.

    A row takes the one branch of its event, so a line is parsed once and no
    record kind costs a scan or a shuffle of its own.  Without ``extended`` task
    events are filtered out first, which the sources turn into unparsed lines.
    """
    builders = {**BASIC, **TASK} if extended else BASIC
    branches = []
    for event, builder in builders.items():
        items = [f"IF({record.present}, {render(record)}, NULL)" for record in builder(compat)]
        branches.append(f"WHEN '{event}' THEN array({', '.join(items)})")
    return (
        with_stage_counters(events)
        .where(F.col("Event").isin(*builders))
        .selectExpr(f"CASE Event {' '.join(branches)} END AS _records")
        # explode_outer: for plain explode Spark infers a size filter below the
        # projection and evaluates the whole rendering a second time for it.
        .select(F.explode_outer("_records").alias("_record"))
        .where(F.col("_record").isNotNull())
        .select("_record.*")
    )


def as_struct(columns: dict[str, str]) -> str:
    """SQL of a struct with the given columns."""
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in columns.items()) + ")"


def as_json(record: Record, epoch: str | None = None, pretty: bool = False) -> str:
    """SQL of the record's map as JSON text, missing values as null."""
    options = "'ignoreNullFields', 'false'" + (", 'pretty', 'true'" if pretty else "")
    content = as_struct({field.name: field.value for field in record.entries(epoch)})
    return f"to_json({content}, map({options}))"


def records(
    events: DataFrame,
    extended: bool = False,
    compat: bool = False,
    capture_time: bool = False,
) -> DataFrame:
    """The mixed stream ``(metricType, name, appId, epochMillis, payload)``.

    ``epochMillis`` is the event's own time; ``capture_time`` stamps the time of
    processing instead, as a live listener would.
    """
    now = "unix_millis(current_timestamp())" if capture_time else None

    def render(record: Record) -> str:
        return as_struct(
            {
                "metricType": record.metric_type,
                "name": f"'{record.name}'",
                "appId": "appId",
                "epochMillis": f"CAST({now or record.time} AS bigint)",
                "payload": as_json(record, now),
            }
        )

    return each_record(events, render, extended, compat)


def application_records(events: DataFrame) -> DataFrame:
    """Application start and end, with the line a driver log would show."""
    started = f"Event = '{schema.APPLICATION_START}'"
    app, attempt = "coalesce(`App ID`, 'noAppId')", "coalesce(`App Attempt ID`, 'N/A')"
    # The two lines as a driver log has them.
    start_message = f"""concat('Spark application started, Application Name: ', `App Name`,
        ', Application ID: ', {app}, ', Time: ', Timestamp, ', Spark User: ', User,
        ', App Attempt ID: ', {attempt})"""
    return events.where(
        F.col("Event").isin(*schema.APPLICATION_EVENTS) & F.col("Timestamp").isNotNull()
    ).selectExpr(
        f"IF({started}, 'application_started', 'application_ended') AS name",
        "`App Name` AS appName",
        f"IF({started}, {app}, appId) AS appId",
        "Timestamp AS time",
        "User AS sparkUser",
        f"IF({started}, {attempt}, NULL) AS appAttemptId",
        f"""IF({started}, {start_message},
            concat('Spark application ended, timestamp = ', Timestamp)) AS message""",
    )
