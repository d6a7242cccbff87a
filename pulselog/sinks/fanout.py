"""Several sinks on one stream, none able to harm the others."""

from __future__ import annotations

import json
import logging
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from pulselog.shared_files import read_small, write_small
from pulselog.sinks.push import Delivery

log = logging.getLogger(__name__)

# A sink may say how many requests of the batch it has delivered.
Sink = Callable[[DataFrame, int], Delivery | None]


class Ledger:
    """What each sink has done so far, in a folder that outlives the stream.

    A small file for each sink holds its last batch and its totals. Spark replays a batch until it
    is committed, and never an earlier one, so the last batch is all that a replay can meet.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, sink: str) -> dict:
        text = read_small(self.spark, f"{self.folder}/{sink}.json")
        return json.loads(text) if text else {"batch": -1, "ok": True, "before": {}, "now": {}}

    def write(self, sink: str, entry: dict) -> None:
        write_small(self.spark, f"{self.folder}/{sink}.json", json.dumps(entry))


class FanOut:
    """A ``foreachBatch`` function that hands each batch to every sink.

    A sink that raises is logged and counted; the others still get the batch and
    the stream goes on.  With a ledger, a batch replayed after a crash reaches only the sinks
    that have not had it, and counts go on from where they were: each batch counts once for
    each sink. What a sink did between its last delivery and the ledger's entry it does again;
    without a ledger every replay reaches every sink.
    ``requests`` adds up what sinks say of their deliveries.
    With more than one sink the batch is kept for its duration, so that source
    and parser run once; lost blocks are recomputed from the source.
    """

    def __init__(self, ledger: Ledger | None = None, /, **sinks: Sink):
        self.sinks, self.ledger = sinks, ledger
        self.delivered: Counter[str] = Counter()
        self.failed: Counter[str] = Counter()
        self.requests: dict[str, Counter[str]] = {name: Counter() for name in sinks}
        self.entries = {}
        for name in sinks if ledger else ():
            self.entries[name] = ledger.read(name)
            self._count(name, self.entries[name]["before"])
            self._count(name, self.entries[name]["now"])

    def _count(self, name: str, counts: dict[str, int], sign: int = 1) -> None:
        totals = (
            (self.delivered, name, "batches"),
            (self.failed, name, "failed_batches"),
            (self.requests[name], "delivered", "delivered"),
            (self.requests[name], "failed", "failed"),
        )
        for total, key, kind in totals:
            if counts.get(kind):
                total[key] += sign * counts[kind]
                if not total[key]:
                    del total[key]

    def _had(self, name: str, batch_id: int) -> bool:
        entry = self.entries.get(name)
        return entry is not None and entry["batch"] == batch_id and entry["ok"]

    def _done(self, name: str, batch_id: int, counts: dict[str, int]) -> None:
        if self.ledger:
            entry = self.entries[name]
            before = Counter(entry["before"])
            if entry["batch"] == batch_id:  # another attempt takes the place of the failed one
                self._count(name, entry["now"], -1)
            else:
                before.update(entry["now"])
            ok = not counts.get("failed_batches")
            entry = {"batch": batch_id, "ok": ok, "before": dict(before), "now": counts}
            self.ledger.write(name, entry)
            self.entries[name] = entry
        self._count(name, counts)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        todo = {name: sink for name, sink in self.sinks.items() if not self._had(name, batch_id)}
        shared = len(todo) > 1
        if shared:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, sink in todo.items():
                try:
                    outcome = sink(batch, batch_id)
                except Exception:
                    log.exception("sink %s failed on batch %d", name, batch_id)
                    self._done(name, batch_id, {"failed_batches": 1})
                    continue
                counts = {"batches": 1}
                if isinstance(outcome, Delivery):
                    counts |= {"delivered": outcome.delivered, "failed": outcome.failed}
                self._done(name, batch_id, counts)
        finally:
            if shared:
                batch.unpersist()
