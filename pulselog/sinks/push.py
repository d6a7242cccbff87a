"""Delivery of push requests."""

from __future__ import annotations

import http.client
import logging
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Answers that count as delivered, and seconds before giving up.
DELIVERED = (200, 201, 202)
TIMEOUT = 5.0

# One request of a partition: (url, content type, body) -> HTTP status.
Post = Callable[[str, str, bytes], int]
# Called once per partition, so that its requests can share a connection.
Transport = Callable[[], Post]


@dataclass(frozen=True)
class Delivery:
    delivered: int
    failed: int


def _target(url: str) -> tuple[str, str]:
    """Host and path of a push address: all behind the host is path, ``?`` and ``#`` included."""
    host, _, path = url.partition("://")[2].partition("/")
    return host, "/" + quote(path, safe="/%:@!$&'()*+,;=~")


def http_post() -> Post:
    """Keeps one connection per host for the requests of a partition.

    A gateway may close a connection between two pushes: one that was used before and breaks is
    replaced once.
    """
    connections: dict[str, http.client.HTTPConnection] = {}

    def send(host: str, path: str, content_type: str, body: bytes) -> int:
        connection = connections.get(host)
        if connection is None:
            connection = http.client.HTTPConnection(host, timeout=TIMEOUT)
            connections[host] = connection
        try:
            connection.request("POST", path, body, {"Content-Type": content_type})
            response = connection.getresponse()
            response.read()
            return response.status
        except Exception:
            connections.pop(host).close()
            raise

    def post(url: str, content_type: str, body: bytes) -> int:
        host, path = _target(url)
        used = host in connections
        try:
            return send(host, path, content_type, body)
        except ConnectionError:
            if not used:
                raise
            return send(host, path, content_type, body)

    return post


def _send(batches: Iterable[pa.RecordBatch], transport: Transport) -> Iterator[pa.RecordBatch]:
    post = transport()
    for batch in batches:
        delivered = failed = 0
        for row in batch.to_pylist():
            try:
                status = post(row["url"], row["content_type"], row["body"].encode("utf-8"))
                problem = None if status in DELIVERED else f"response {status}"
            except Exception as error:  # reporting must never break the job
                problem = str(error)
            if problem is None:
                delivered += 1
            else:
                failed += 1
                log.error("push to %s failed: %s", row["url"], problem)
        yield pa.RecordBatch.from_pydict(
            {"delivered": pa.array([delivered]), "failed": pa.array([failed])}
        )


def deliver(
    requests: DataFrame, transport: Transport = http_post, connections: int | None = None
) -> Delivery:
    """Sends all requests, each partition over its own connection; failures are counted.

    Answers are not retried and nothing is raised.  ``connections`` bounds how many
    partitions talk to the gateway at the same time; the requests are moved for
    it, so that parsing them keeps its own parallelism.
    """
    rows = requests.select("url", "content_type", "body")
    if connections:
        rows = rows.repartition(connections)
    counts = rows.mapInArrow(
        lambda batches: _send(batches, transport), "delivered bigint, failed bigint"
    )
    total = counts.agg(
        F.coalesce(F.sum("delivered"), F.lit(0)).alias("delivered"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    ).first()
    return Delivery(total["delivered"], total["failed"])
