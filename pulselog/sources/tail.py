"""A streaming source of log files that still grow.

``spark.readStream.format("log_tail").option("path", folder)`` gives each whole line once, as soon
as it is there: ``value`` and the file's ``path``. The offset holds the bytes read of every file. A
file keeps its place when its writer seals it by renaming: ``events_1.inprogress`` and ``events_1``
are one file. A last line without its line feed waits, until the file is sealed.

Spark plans a batch from two offsets, and tasks read the ranges between them in parts of
``partBytes``, so a restart reads exactly what the checkpoint has not seen. Files are read through
pyarrow's file systems; compressed files can't be read in part and are refused.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source's processes get this module by value: they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "log_tail"
OPEN = ".inprogress"
COMPRESSED = (".gz", ".zst", ".zstd", ".lz4", ".lzf", ".snappy")
PART_BYTES = 64 << 20
BATCH_ROWS = 10_000
READ_BYTES = 4 << 20
#: Listings without a file after which it counts as deleted.
MISSES = 3


def _files(path: str):
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path.rstrip("/")
    return fs.FileSystem.from_uri(path)


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.part_bytes = int(options.get("partbytes", PART_BYTES))
        self.known: dict[str, int] = {}
        self.missed: dict[str, int] = {}

    def _listed(self) -> dict[str, tuple[int, bool]]:
        """Bytes of each file by its sealed name, and whether it is sealed."""
        from pyarrow import fs

        files, root = _files(self.path)
        found: dict[str, tuple[int, bool]] = {}
        for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = info.path[len(root) :].lstrip("/")
            hidden = any(part.startswith(("_", ".")) for part in name.split("/"))
            if info.type != fs.FileType.File or hidden or name.startswith("appstatus"):
                continue
            if name.removesuffix(OPEN).endswith(COMPRESSED):
                raise ValueError(f"{name}: compressed files can't be tailed")
            sealed = not name.endswith(OPEN)
            name = name.removesuffix(OPEN)
            # Between the two names of a rename both may be listed: the larger one counts.
            size, was = found.get(name, (0, False))
            found[name] = (max(size, info.size), sealed or was)
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Whole lines of every file: up to its last line feed, or to its end once it is sealed."""
        offset = {}
        for name, (size, sealed) in self._listed().items():
            end = size if sealed else self._last_line(name, size)
            if end:
                offset[name] = max(end, self.known.get(name, 0))
        # A listing may miss a file that is being renamed: only one that stays away is forgotten.
        self.missed = {n: self.missed.get(n, 0) + 1 for n in self.known if n not in offset}
        offset |= {n: self.known[n] for n, times in self.missed.items() if times < MISSES}
        self.known = offset
        return dict(sorted(offset.items()))

    def _open(self, name: str):
        files, root = _files(self.path)
        try:
            return files.open_input_file(f"{root}/{name}")
        except FileNotFoundError:
            return files.open_input_file(f"{root}/{name}{OPEN}")

    def _last_line(self, name: str, size: int) -> int:
        with self._open(name) as file:
            while size:
                start = max(0, size - (64 << 10))
                at = file.read_at(size - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                size = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Parts of the new bytes of each file: name, part's start and stop, range's start and stop."""
        parts = []
        for name, last in end.items():
            first = start.get(name, 0)
            for at in range(first, last, self.part_bytes):
                upto = min(last, at + self.part_bytes)
                parts.append(InputPartition((name, at, upto, first, last)))
        return parts

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """The lines that begin in a part; the last one may end behind it."""
        name, start, stop, first, last = partition.value
        whole = f"{self.path.rstrip('/')}/{name}"
        values: list[str] = []
        with self._open(name) as file:
            at, rest = start, b""
            skip = start > first and file.read_at(1, start - 1) != b"\n"
            while at < last:
                chunk = file.read_at(min(READ_BYTES, last - at), at)
                if not chunk:
                    raise OSError(f"{whole} has become shorter than {last} bytes")
                at += len(chunk)
                lines = (rest + chunk).split(b"\n")
                rest = lines.pop()
                place = at - len(rest) - sum(len(line) + 1 for line in lines)
                for line in lines:
                    if place >= stop:
                        break
                    place += len(line) + 1
                    if skip:
                        skip = False
                        continue
                    values.append(line.decode("utf-8", "replace").removesuffix("\r"))
                    if len(values) >= BATCH_ROWS:
                        yield _rows(values, whole)
                        values = []
                if place >= stop:
                    rest = b""
                    break
            if rest and not skip:
                values.append(rest.decode("utf-8", "replace"))
        if values:
            yield _rows(values, whole)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def _rows(values: list[str], path: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, pa.string()), pa.array([path] * len(values), pa.string())],
        ["value", "path"],
    )


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, path string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def tail_lines(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Lines of the log files below a folder, each once, also while they are being written.

    ``parse_events`` takes them as they are.
    """
    spark.dataSource.register(LogTail)
    return spark.readStream.format(FORMAT).option("path", path).option("partBytes", part_bytes).load()
