"""Lines of growing files: each once, over batches, restarts and renames."""

import json

import pytest
from pyspark.sql import functions as F
from samplelog import LINES

from pulselog import operators as ops
from pulselog import schema
from pulselog.sources import parse_events, read_events, tail_lines
from pulselog.sources.tail import TailReader
from pulselog.streaming import records_table, stream_to


class Log:
    """An application's log as Spark writes it: open under one name, sealed under another."""

    def __init__(self, folder, app):
        self.sealed = folder / f"eventlog_v2_{app}" / f"events_1_{app}"
        self.sealed.parent.mkdir(parents=True, exist_ok=True)
        self.open = self.sealed.with_name(self.sealed.name + ".inprogress")

    def write(self, text):
        with self.open.open("a", encoding="utf-8") as file:
            file.write(text)

    def seal(self):
        self.open.rename(self.sealed)


def tailed(spark, folder, tmp_path, part_bytes=64 << 20):
    """What a run of the stream finds new, and all that it has found so far."""
    table = records_table(spark, str(tmp_path / "out"))
    lines = tail_lines(spark, str(folder), part_bytes)
    rows = lines.select("value", "path", F.lit("line").alias("name"))
    stream = stream_to(rows, table, str(tmp_path / "checkpoint"), mode="append")
    stream.awaitTermination()
    new = sum(p["numInputRows"] for p in stream.recentProgress)
    try:
        return new, sorted(r.value for r in table.read().collect())
    except ValueError:
        return new, []


@pytest.mark.parametrize("part_bytes", [7, 64 << 20])
def test_growing_files(spark, tmp_path, part_bytes):
    folder = tmp_path / "logs"
    folder.mkdir()
    one, two = Log(folder, "app-1"), Log(folder, "app-2")
    run = lambda: tailed(spark, folder, tmp_path, part_bytes)
    one.write("a first line\nsecond ü\nhalf of")
    assert run() == (2, ["a first line", "second ü"])
    assert run()[0] == 0
    one.write(" the third\n\nfifth\r\n")
    two.write("other\n")
    new, lines = run()
    assert new == 4 and lines == sorted(
        ["a first line", "second ü", "half of the third", "", "fifth", "other"]
    )
    one.write("last, no line feed")
    assert run()[0] == 0
    one.seal()
    new, lines = run()
    assert new == 1 and "last, no line feed" in lines and len(lines) == 7
    two.seal()
    assert run()[0] == 0


def test_parts_of_any_size_give_each_line_once(tmp_path):
    lines = ["x" * n for n in (0, 1, 2, 30, 0, 5, 64, 3)]
    (tmp_path / "log").write_text("\n".join(lines), encoding="utf-8")
    for part_bytes in range(1, 40):
        reader = TailReader({"path": str(tmp_path), "partbytes": str(part_bytes)})
        end = reader.latestOffset()
        got = [
            value
            for part in reader.partitions({}, end)
            for batch in reader.read(part)
            for value in batch["value"].to_pylist()
        ]
        assert got == lines


def test_file_that_a_listing_misses(tmp_path):
    log = tmp_path / "log"
    log.write_text("one\ntwo\n")
    reader = TailReader({"path": str(tmp_path)})
    first = reader.latestOffset()
    moved = log.rename(tmp_path / ".log")
    assert reader.latestOffset() == first
    moved.rename(log)
    assert reader.latestOffset() == first == {"log": 8}
    log.unlink()
    assert [reader.latestOffset() for _ in range(3)][-1] == {}


def test_compressed_files_are_refused(tmp_path):
    (tmp_path / "log.zstd").write_bytes(b"x")
    with pytest.raises(ValueError, match="compressed"):
        TailReader({"path": str(tmp_path)}).latestOffset()


def test_records_of_a_live_log_equal_those_of_the_sealed_one(spark, tmp_path):
    folder = tmp_path / "logs"
    log = Log(folder, "app-9")
    table = records_table(spark, str(tmp_path / "out"))
    text = "\n".join(LINES) + "\n"
    cuts = [0, len(text) // 3, 2 * len(text) // 3, len(text)]
    for start, stop in zip(cuts, cuts[1:]):
        log.write(text[start:stop])
        events = parse_events(tail_lines(spark, str(folder)), schema.EXTENDED_KINDS)
        records = ops.records(events, extended=True)
        stream_to(records, table, str(tmp_path / "checkpoint"), mode="append").awaitTermination()
    log.seal()
    want = ops.records(read_events(spark, str(folder), schema.EXTENDED_KINDS), extended=True)
    got = table.read().select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    assert json.loads(got.first().payload)["appId"] == "app-9"
