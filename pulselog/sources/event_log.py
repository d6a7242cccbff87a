"""Spark event logs as DataFrames.

Every reader yields ``appId``, ``Event`` and the top-level line fields that the
chosen record kinds need; operators take it from there and never look at the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselog.functions.lines import NO_APP_ID, app_id_from_path, event_hint
from pulselog.schema import ALL_KINDS, kind_events, line_ddl, line_fields


def _from_files(files: DataFrame, kinds) -> DataFrame:
    # `Event IN (…)` is pushed into the JSON scan: the parser gives a line up as
    # soon as it has read the name.  Unreadable lines have no Event and drop out.
    return files.where(F.col("Event").isin(*kind_events(kinds))).select(
        app_id_from_path(F.col("_metadata.file_path")).alias("appId"),
        "Event",
        *[f"`{name}`" for name in line_fields(kinds)],
    )


def read_events(spark: SparkSession, path: str | list[str], kinds=ALL_KINDS) -> DataFrame:
    """Event logs below a path (rolling directories, single files, archives).

    Plain and zstd files are read as they are.  A compressed file is one split,
    so rolling logs (``spark.eventLog.rolling``) set the parallelism.
    """
    reader = spark.read.schema(line_ddl(kinds)).option("recursiveFileLookup", "true")
    return _from_files(reader.json(path), kinds)


def read_event_stream(
    spark: SparkSession,
    path: str,
    kinds=ALL_KINDS,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The same as a stream.  Only sealed files belong below the path: a file is read once."""
    reader = spark.readStream.schema(line_ddl(kinds)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return _from_files(reader.json(path), kinds)


def parse_events(lines: DataFrame, kinds=ALL_KINDS) -> DataFrame:
    """Event-log lines that already are rows (a topic, a table): ``value[, appId | path]``.

    A hint of the event comes off the raw line, so lines of other events are dropped
    unparsed; whether a line counts is up to the parse alone, as for files: broken lines drop
    out, and ``event_log_counts`` counts them.  The parse sits inside a generator because Spark would otherwise
    copy it into every later filter on a parsed field and parse each line twice.
    """
    value = F.col("value").cast("string")
    if "appId" in lines.columns:
        app = F.coalesce(F.col("appId"), F.lit(NO_APP_ID))
    elif "path" in lines.columns:
        app = app_id_from_path(F.col("path"))
    else:
        app = F.lit(NO_APP_ID)
    parsed = F.from_json("_line", line_ddl(kinds))
    return (
        lines.select(app.alias("appId"), event_hint(value).alias("_hint"), value.alias("_line"))
        .where(F.col("_hint").isin(*kind_events(kinds)))
        .select("appId", F.explode(F.array(parsed)).alias("_parsed"))
        .where(F.col("_parsed.Event").isin(*kind_events(kinds)))
        .select("appId", "_parsed.Event", *[f"_parsed.`{name}`" for name in line_fields(kinds)])
    )
