"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrites a folder with JSON lines.

    An ordered result stays ordered over its part files.  ``files=1`` gives the
    single file a small report wants; left out, every partition writes its own.
    """
    if files is None:
        rows.write.mode("overwrite").json(path)
    else:
        rows.coalesce(files).write.mode("overwrite").json(path)


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """Mixed records as parquet, one folder per record name, so readers prune by name."""
    records.write.mode(mode).partitionBy("name").parquet(path)
