"""Replayed batches: each counts once for each sink, and reaches only sinks that lack it."""

import pytest
from samplelog import LINES

from pulselog import schema, streaming
from pulselog.sinks import Delivery, FanOut, Ledger
from pulselog.sources import read_event_stream


def test_replay_reaches_only_who_lacks_it(spark, tmp_path):
    batch, pushed, flaky = spark.range(3), [], {"fails": True}

    def push(rows, batch_id):
        pushed.append(batch_id)
        return Delivery(delivered=rows.count(), failed=1)

    def kafka(rows, batch_id):
        if flaky["fails"]:
            raise RuntimeError("broker down")

    def fan():
        return FanOut(Ledger(spark, str(tmp_path / "ledger")), push=push, kafka=kafka)

    first = fan()
    first(batch, 0)
    first(batch, 1)
    assert (first.delivered["push"], first.failed["kafka"]) == (2, 2)
    # The process dies before batch 1 is committed; the next one gets it again.
    flaky["fails"] = False
    second = fan()
    assert (second.delivered["push"], second.failed["kafka"]) == (2, 2)
    second(batch, 1)
    assert pushed == [0, 1]
    assert (second.delivered["push"], second.failed["push"]) == (2, 0)
    assert (second.delivered["kafka"], second.failed["kafka"]) == (1, 1)
    assert second.requests["push"] == {"delivered": 6, "failed": 2}
    second(batch, 2)
    third = fan()
    assert (third.delivered["push"], third.delivered["kafka"], third.failed["kafka"]) == (3, 2, 1)
    assert third.requests["push"] == {"delivered": 9, "failed": 3}


def test_crash_before_the_entry_delivers_again(spark, tmp_path):
    ledger, pushed = Ledger(spark, str(tmp_path / "ledger")), []

    def push(rows, batch_id):
        pushed.append(batch_id)

    fan = FanOut(ledger, push=push)

    def crash(sink, entry):
        raise OSError("power cut")

    ledger.write = crash
    with pytest.raises(OSError):
        fan(spark.range(1), 0)
    again = FanOut(Ledger(spark, str(tmp_path / "ledger")), push=push)
    again(spark.range(1), 0)
    assert pushed == [0, 0] and again.delivered["push"] == 1


def test_stream_that_dies_between_push_and_commit(spark, tmp_path):
    """The stream fails after its sinks are done; the restart commits without pushing again."""
    folder = tmp_path / "logs" / "eventlog_v2_app-9"
    folder.mkdir(parents=True)
    for part in range(3):
        text = "\n".join(LINES[part::3]) + "\n"
        (folder / f"events_{part}_app-9").write_text(text, encoding="utf-8")
    events = read_event_stream(spark, str(folder.parent), schema.BASIC_KINDS, 1)
    pushed = []

    def push(rows, batch_id):
        pushed.append(batch_id)
        return Delivery(rows.count(), 0)

    checkpoint = str(tmp_path / "checkpoint")
    fan = FanOut(Ledger(spark, f"{checkpoint}/ledger"), push=push)

    def dies(rows, batch_id):
        fan(rows, batch_id)
        if batch_id == 1:
            raise RuntimeError("driver lost")

    writer = events.writeStream.foreachBatch(dies).option("checkpointLocation", checkpoint)
    run = writer.trigger(availableNow=True).start()
    with pytest.raises(Exception, match="driver lost"):
        run.awaitTermination()
    assert pushed == [0, 1]
    run, restarted = streaming.fan_out(events, checkpoint, push=push)
    run.awaitTermination()
    assert pushed == [0, 1, 2]
    assert restarted.delivered["push"] == 3
    counted = spark.read.text(str(folder)).count()
    assert 0 < restarted.requests["push"]["delivered"] <= counted
