"""Prometheus samples, exposition text and push requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselog.functions.names import or_default, sanitize_label_name
from pulselog.operators.catalogue import Record
from pulselog.operators.records import as_struct, each_record

INSTANCE = "pulselog"
# Which entries of a record are numbers for Prometheus: Long only, or Int too.
NUMERIC_TYPES = {"long": ("bigint",), "all": ("bigint", "int")}


def sample_values(record: Record, numeric: str = "long") -> dict[str, str]:
    """Metric name -> SQL of the record's numeric entries, sorted so that texts are reproducible.

    Entry names are plain letters: lower-casing is all that sanitising does to them.
    """
    kept = [field for field in record.entries() if field.type in NUMERIC_TYPES[numeric]]
    return {
        field.name.lower(): f"CAST({field.value} AS bigint)"
        for field in sorted(kept, key=lambda field: field.name.lower())
    }


def prometheus_samples(
    events: DataFrame,
    job: str = "no-job-name",
    instance: str = INSTANCE,
    extended: bool = False,
    compat: bool = False,
    numeric: str = "long",
) -> DataFrame:
    """Samples in long form: ``(job, instance, type, appid, metric, value, epochMillis)``."""

    def render(record: Record) -> str:
        samples = [
            as_struct({"metric": f"'{metric}'", "value": value})
            for metric, value in sample_values(record, numeric).items()
        ]
        return as_struct(
            {
                "type": record.metric_type,
                "appid": "appId",
                "epochMillis": f"CAST({record.time} AS bigint)",
                "samples": f"array({', '.join(samples)})",
            }
        )

    return (
        each_record(events, render, extended, compat)
        .select("type", "appid", "epochMillis", F.explode_outer("samples").alias("sample"))
        .where(F.col("sample.value").isNotNull())
        .select(
            F.lit(job).alias("job"),
            F.lit(instance).alias("instance"),
            "type",
            "appid",
            "sample.metric",
            "sample.value",
            "epochMillis",
        )
    )


def exposition_text(
    events: DataFrame,
    extended: bool = False,
    compat: bool = False,
    numeric: str = "long",
) -> DataFrame:
    """One text per record: ``(type, appid, text)``, a ``name value`` line per sample."""

    def render(record: Record) -> str:
        # A missing value makes its line null, and concat_ws leaves nulls out.
        lines = [
            f"concat('{metric} ', {value})"
            for metric, value in sample_values(record, numeric).items()
        ]
        text = f"concat(concat_ws('\\n', {', '.join(lines)}), '\\n')"
        return as_struct({"type": record.metric_type, "appid": "appId", "text": text})

    return each_record(events, render, extended, compat)


def push_url(
    host: str,
    job: str,
    metric_type: Column,
    label_name: Column,
    label_value: Column,
    instance: str = INSTANCE,
) -> Column:
    """Push address of a group.  Only the label name is sanitised; nothing is escaped."""
    return F.concat(
        F.lit(f"http://{host}/metrics/job/{job}/instance/{instance}/type/"),
        or_default(metric_type, "NoType"),
        F.lit("/"),
        or_default(sanitize_label_name(label_name), "NoLabelName"),
        F.lit("/"),
        or_default(label_value, "NoLabelValue"),
    )


def push_requests(texts: DataFrame, host: str, job: str, instance: str = INSTANCE) -> DataFrame:
    """POST requests ``(url, content_type, body)`` for :func:`exposition_text` rows."""
    url = push_url(host, job, F.col("type"), F.lit("appid"), F.col("appid"), instance)
    return texts.select(
        url.alias("url"), F.lit("text/plain").alias("content_type"), F.col("text").alias("body")
    )
