import pytest
from samplelog import LINES

from pulselog import Settings
from pulselog.plans.jobs import count_words, telemetry


def recording_transport(folder):
    def open_connection():
        def post(url, content_type, body):
            (kind, app) = url.split("/type/")[1].split("/appid/")
            with open(f"{folder}/{kind}", "wb") as file:
                file.write(body)
            return 200

        return post

    return open_connection


@pytest.mark.parametrize("extended, pushed", [(False, 11), (True, 16)])
def test_telemetry_pushes_every_record(spark, tmp_path, extended, pushed):
    log, out = tmp_path / "eventlog_v2_app-9", tmp_path / "pushed"
    log.mkdir()
    out.mkdir()
    (log / "events_1_app-9").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    settings = Settings(extended=extended, job="j", push_gateway="gw:1")
    query, fan = telemetry(
        spark,
        str(log),
        str(tmp_path / "checkpoint"),
        settings,
        transport=recording_transport(str(out)),
    )
    query.awaitTermination()
    assert not fan.failed
    bodies = {path.name: path.read_text() for path in out.iterdir()}
    assert len(bodies) == pushed
    assert bodies["jobStart-6"] == "epochmillis 2100\njobid 6\nstarttime 2100\n"


def test_telemetry_survives_a_sink_that_cannot_work(spark, tmp_path):
    log = tmp_path / "eventlog_v2_app-9"
    log.mkdir()
    (log / "events_1_app-9").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    # There is no Kafka connector in this installation.
    settings = Settings(kafka_broker="b:9092", kafka_topic="t")
    query, fan = telemetry(spark, str(log), str(tmp_path / "checkpoint"), settings)
    query.awaitTermination()
    assert query.exception() is None
    assert fan.failed == {"kafka": 1}


def test_telemetry_needs_a_sink(spark, tmp_path):
    with pytest.raises(ValueError):
        telemetry(spark, str(tmp_path), str(tmp_path / "c"), Settings())
    with pytest.raises(ValueError):
        telemetry(spark, str(tmp_path), str(tmp_path / "c"), Settings(kafka_topic="t"))


def test_count_words(spark, tmp_path):
    (tmp_path / "book.txt").write_text("The sea, the SEA!\n  a I the\n", encoding="utf-8")
    target = str(tmp_path / "counts")
    count_words(spark, str(tmp_path / "book.txt"), target, files=1)
    rows = spark.read.schema("word string, count bigint").json(target).collect()
    assert (rows[0]["word"], rows[0]["count"]) == ("the", 3)
    assert {tuple(row) for row in rows[1:]} == {("sea,", 1), ("sea!", 1)}


def test_live_telemetry_follows_a_growing_log(spark, tmp_path):
    log, out = tmp_path / "eventlog_v2_app-9", tmp_path / "pushed"
    log.mkdir()
    out.mkdir()
    file = log / "events_1_app-9.inprogress"
    settings = Settings.read({"x.live": "true", "x.pushgateway": "gw:1"}, "x")
    text = "\n".join(LINES) + "\n"
    half = len(text) // 2
    requests = []
    for part in (text[:half], text[half:]):
        with file.open("a", encoding="utf-8") as growing:
            growing.write(part)
        query, fan = telemetry(
            spark, str(log), str(tmp_path / "checkpoint"), settings,
            transport=recording_transport(str(out)),
        )
        query.awaitTermination()
        requests.append(fan.requests["push"]["delivered"])
    assert 0 < requests[0] < requests[1] == 11
    assert len(list(out.iterdir())) == 11
