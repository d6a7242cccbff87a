import http.client
import logging

import pytest
from pyspark.sql import functions as F
from samplelog import LINES

from pulselog import operators as ops
from pulselog import sinks
from pulselog.sinks import push
from pulselog.sources import parse_events


@pytest.fixture()
def events(spark):
    return parse_events(spark.createDataFrame([(line,) for line in LINES], "value string"))


def fake_transport(log_dir):
    """A gateway that accepts most pushes, rejects jobs and drops the connection on queries."""

    def open_connection():
        def post(url, content_type, body):
            if "/type/job" in url:
                return 500
            if "/type/query" in url:
                raise ConnectionError("connection reset")
            with open(f"{log_dir}/{url.split('/type/')[1].replace('/', '_')}", "wb") as file:
                file.write(content_type.encode() + b"\n" + body)
            return 202

        return post

    return open_connection


def test_delivery_counts_failures_and_never_raises(events, tmp_path):
    requests = ops.push_requests(ops.exposition_text(events), "gw:1", "j")
    outcome = sinks.deliver(requests, fake_transport(str(tmp_path)), connections=2)
    files = {path.name: path.read_bytes() for path in tmp_path.iterdir()}
    assert (outcome.delivered, outcome.failed) == (len(files), 5)
    assert files["executorAdded-5_appid_noAppId"] == b"text/plain\nepochmillis 200\ntime 200\n"


def test_delivery_of_nothing(events, tmp_path):
    nothing = ops.push_requests(ops.exposition_text(events.where("false")), "gw:1", "j")
    assert sinks.deliver(nothing, fake_transport(str(tmp_path))) == push.Delivery(0, 0)


class FakeConnection:
    opened = []

    def __init__(self, netloc, timeout):
        self.netloc, self.timeout, self.requests = netloc, timeout, []
        FakeConnection.opened.append(self)

    def request(self, method, path, body, headers):
        if path.endswith("/broken"):
            raise TimeoutError("timed out")
        if path.endswith("/stale") and self.requests:
            raise ConnectionResetError("closed by the gateway")
        self.requests.append((method, path, body, headers))

    def getresponse(self):
        class Response:
            status = 200

            def read(self):
                return b""

        return Response()

    def close(self):
        self.netloc = None


def test_http_transport_keeps_its_connection(monkeypatch):
    monkeypatch.setattr(http.client, "HTTPConnection", FakeConnection)
    FakeConnection.opened = []
    post = sinks.http_post()
    url = "http://gw:1/metrics/job/test-job/instance/box/type/testType/testLabelName/testLabelValue"
    assert post(url, "text/plain", b"testMetricsData") == 200
    assert post(url, "text/plain", b"more") == 200
    (connection,) = FakeConnection.opened
    assert (connection.netloc, connection.timeout) == ("gw:1", 5.0)
    assert connection.requests[0] == (
        "POST",
        "/metrics/job/test-job/instance/box/type/testType/testLabelName/testLabelValue",
        b"testMetricsData",
        {"Content-Type": "text/plain"},
    )
    with pytest.raises(TimeoutError):
        post("http://gw:1/broken", "text/plain", b"")
    assert post(url, "text/plain", b"again") == 200
    assert len(FakeConnection.opened) == 2


def test_http_transport_replaces_a_stale_connection_once(monkeypatch):
    monkeypatch.setattr(http.client, "HTTPConnection", FakeConnection)
    FakeConnection.opened = []
    post = sinks.http_post()
    assert post("http://gw:1/fresh", "text/plain", b"1") == 200
    assert post("http://gw:1/stale", "text/plain", b"2") == 200
    first, second = FakeConnection.opened
    assert [r[2] for r in first.requests] == [b"1"]
    assert [r[2] for r in second.requests] == [b"2"]


def test_whole_address_is_path(monkeypatch):
    monkeypatch.setattr(http.client, "HTTPConnection", FakeConnection)
    FakeConnection.opened = []
    assert sinks.http_post()("http://gw:1/type/a?b#c d/appid/x%2F1", "text/plain", b"") == 200
    assert FakeConnection.opened[0].requests[0][1] == "/type/a%3Fb%23c%20d/appid/x%2F1"


def test_kafka_options():
    options = sinks.kafka_options("b:9092", "metrics")
    assert options["kafka.bootstrap.servers"] == "b:9092"
    assert options["topic"] == "metrics"
    assert options["kafka.retries"] == "10"
    assert options["kafka.batch.size"] == "16384"
    assert options["kafka.linger.ms"] == "0"
    assert options["kafka.buffer.memory"] == "16384000"
    with pytest.raises(ValueError):
        sinks.kafka_options("", "metrics")
    with pytest.raises(ValueError):
        sinks.kafka_options("b:9092", "")


def test_json_files_keep_order(spark, tmp_path):
    lines = spark.createDataFrame([("b b a a a cc cc Cc ccc",), (" ccc dd ",)], "value string")
    path = str(tmp_path / "words")
    sinks.write_json(ops.word_count(lines), path, files=1)
    files = [p for p in (tmp_path / "words").iterdir() if p.suffix == ".json"]
    assert len(files) == 1
    rows = spark.read.schema("word string, count bigint").json(path).collect()
    assert [tuple(row) for row in rows] == [("cc", 3), ("ccc", 2), ("dd", 1)]
    sinks.write_json(ops.word_count(lines.limit(1)), path)
    assert spark.read.json(path).count() == 2


def test_record_files_are_pruned_by_name(spark, events, tmp_path):
    path = str(tmp_path / "records")
    sinks.write_records(ops.records(events, extended=True), path)
    jobs = spark.read.parquet(path).where("name = 'jobs_started'")
    plan = jobs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(name" in plan
    assert jobs.count() == 2


def test_fan_out_isolates_sinks(spark, caplog):
    seen = []

    def broken(batch, batch_id):
        raise RuntimeError("no broker")

    fan = sinks.FanOut(broken=broken, good=lambda batch, i: seen.append((i, batch.count())))
    caplog.set_level(logging.CRITICAL)
    fan(spark.range(3).withColumn("x", F.lit(1)), 0)
    fan(spark.range(4).withColumn("x", F.lit(1)), 1)
    assert seen == [(0, 3), (1, 4)]
    assert fan.failed == {"broken": 2}
    assert fan.delivered == {"good": 2}
