"""Stored tables as streams in the order of their event times.

A file source takes files by their modification time, and files of a stored table lie in any
order; a watermark short enough to bound state would drop most of such a replay. So event times
are indexed by file first. Where files already come in order, give or take the delay, they are
read in place, and otherwise from a copy in time order, cut into files with ranges that don't overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from pulselog.functions.order import epoch_micros
from pulselog.session import scratch_dir
from pulselog.shared_files import set_modified

#: Rows of one file of an ordered copy.
FILE_ROWS = 1_000_000
#: Modification times of neighbours differ by so much: every file system tells them apart.
STEP_MILLIS = 1000


def _micros(rows: DataFrame, time: str) -> Column:
    return epoch_micros(F.col(time), isinstance(rows.schema[time].dataType, TimestampNTZType))


def time_index(rows: DataFrame, time: str) -> DataFrame:
    """(file, modified, first, last, rows) of a table of files; times in epoch microseconds.

    Reads the time column alone. Rows without a time count in ``rows``.
    """
    seen = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.unix_millis("_metadata.file_modification_time").alias("modified"),
        _micros(rows, time).alias("at"),
    )
    return seen.groupBy("file", "modified").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("rows")
    )


def lateness(index: DataFrame) -> int:
    """Microseconds by which a file begins before an earlier one ends: the delay that loses nothing.

    Files count in the order a stream takes them. The index has a row a file.
    """
    before = Window.orderBy("modified", "file").rowsBetween(Window.unboundedPreceding, -1)
    behind = F.max("last").over(before) - F.col("first")
    return max(index.select(behind.alias("late")).agg(F.max("late")).first()[0] or 0, 0)


def ordered_copy(rows: DataFrame, time: str, path: str, files: int) -> DataFrame:
    """Writes ``rows`` in time order and returns the copy's index.

    Each file holds a range of times, and their modification times ascend with them. One shuffle;
    rows of one time may fall to two neighbouring files. Rows without a time come first. Needs a
    file system that keeps modification times (local disks, HDFS).
    """
    spark = rows.sparkSession
    tie = "_replay_tie"
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(files, time, tie)
    dealt.sortWithinPartitions(time, tie).drop(tie).write.parquet(path)
    index = time_index(spark.read.schema(rows.schema).parquet(path), time)
    listed = index.orderBy(F.asc_nulls_first("first"), "last", "file").select("file", "modified")
    listed = listed.collect()  # a row a file
    start = max((row.modified for row in listed), default=0) - STEP_MILLIS * len(listed)
    for turn, row in enumerate(listed):
        set_modified(spark, row.file, start + STEP_MILLIS * turn)
    return time_index(spark.read.schema(rows.schema).parquet(path), time)


@dataclass(frozen=True)
class Replay:
    """Where a table is read from, and the least delay that its order calls for."""

    path: str
    files: int
    late_micros: int


def plan_replay(
    spark: SparkSession, rows: DataFrame, time: str, delay_micros: int, files: int | None = None
) -> Replay:
    """Decides between the table's own files and an ordered copy in the shared folder.

    ``rows`` is a table of files as it was read. Its own files do where there are at least
    ``files`` and they come no later than ``delay_micros``.
    """
    index = time_index(rows, time)
    own = index.agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).first()
    wanted = files or max(2, -(-(own["rows"] or 0) // FILE_ROWS))
    late = lateness(index)
    folders = {file.rsplit("/", 1)[0] for file in rows.inputFiles()}
    if own["n"] >= wanted and late <= delay_micros and len(folders) == 1:
        return Replay(folders.pop(), own["n"], late)
    path = scratch_dir(spark, "replay")
    copied = ordered_copy(rows, time, path, wanted)
    return Replay(path, copied.count(), lateness(copied))


def read_replay(
    spark: SparkSession, replay: Replay, rows: DataFrame, files_per_batch: int = 1
) -> DataFrame:
    """The table as a stream, ``files_per_batch`` files at a time in order of their event times."""
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch)
    return source.option("maxFileAge", "36500d").parquet(replay.path)
