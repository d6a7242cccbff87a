"""Variable-capacity best-fit packing over the whole input.

Packing looks at lengths only, and lengths are whole numbers up to the largest capacity. So the
input is counted by length (a bounded table), best-fit-decreasing packs the counts, whole ranges
of equal bins at a time, and the pieces then take their places by their rank among equal lengths.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Permitted sequence lengths, in tokens; a token is a UTF-8 byte or the mark after a document.
CAPACITIES = (2048, 4096, 8192, 16384)


def _packed(counts: dict[int, int], capacities: tuple[int, ...], smallest: int):
    """Best-fit-decreasing of the counts; new bins open at the least size >= ``smallest``.

    Returns runs (length, rank, number, bin): pieces of that length with ranks from ``rank`` on
    go to bins from ``bin`` on, one to each. Also the ranges (bin, number, room left, size).
    """
    room: dict[int, list[tuple[int, int, int]]] = {}
    rooms: list[int] = []
    runs, bins = [], 0

    def put(left: int, start: int, number: int, size: int) -> None:
        if left not in room:
            room[left] = []
            insort(rooms, left)
        room[left].append((start, number, size))

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                size = next(c for c in capacities if c >= max(length, smallest))
                number = -(-todo // (size // length))
                put(size, bins, number, size)
                bins += number
                continue
            left = rooms[at]
            start, number, size = room[left].pop()
            if not room[left]:
                del room[left], rooms[at]
            used = min(number, todo)
            runs.append((length, rank, used, start))
            put(left - length, start, used, size)
            if used < number:
                put(left, start + used, number - used, size)
            rank, todo = rank + used, todo - used
    return runs, [(s, n, left, size) for left, rs in room.items() for s, n, size in rs]


def plan(counts: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, cost=None) -> list:
    """The cheapest packing's runs (length, rank, number, bin).

    Packs once for every least opening size and compares the cost after each bin is downsized to
    the least permitted size that holds its contents. ``cost`` gives the cost of a bin size;
    without it, a bin costs its size.
    """
    capacities = tuple(sorted(capacities))
    cost = cost or (lambda size: size)
    best = None
    for smallest in capacities:
        runs, ranges = _packed(counts, capacities, smallest)
        total = sum(
            n * cost(next(c for c in capacities if c >= size - left))
            for _, n, left, size in ranges
        )
        if best is None or total < best[0]:
            best = (total, runs)
    return best[1]


def pieces(docs: DataFrame, largest: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens): documents cut where they exceed the largest capacity.

    A document is its UTF-8 bytes and one end mark; null and empty texts are the mark alone.
    """
    total = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    docs = docs.select("doc_id", total.alias("total"))
    last = F.floor((F.col("total") - 1) / largest)
    docs = docs.select("doc_id", "total", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece") * largest
    return docs.select(
        "doc_id",
        "piece",
        start.alias("start"),
        F.least(F.col("total") - start, F.lit(largest)).alias("n_tokens"),
    )


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost=None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, n_tokens, bin_id, position, capacity.

    ``position`` is where the piece begins in its bin. Repeated rows are packed each; which of
    equal pieces gets which bin follows their doc_id and piece. An empty table gives no rows.
    """
    capacities = tuple(sorted(capacities))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces(docs, capacities[-1])
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    # A length may be very common: rank it within salts, then add the counts of earlier salts.
    cells = rows.groupBy("n_tokens", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "n_tokens", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    # At most one row for each length up to the largest capacity.
    counts = {r.n_tokens: r["count"] for r in rows.groupBy("n_tokens").count().collect()}
    runs = np.array(plan(counts, capacities, cost), np.int64).reshape(-1, 4)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    widest = int(max(counts.values(), default=0)) + 1
    keys = runs[:, 0] * widest + runs[:, 1]

    def place(batches):
        for batch in batches:
            length = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * widest + rank, "right") - 1
            bins = runs[at, 3] + rank - runs[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(bins)], [*batch.schema.names[:4], "bin_id"]
            )

    order = Window.partitionBy("n_tokens", "salt").orderBy("doc_id", "piece")
    ranked = rows.withColumn("local", F.row_number().over(order) - 1).join(cells, ["n_tokens", "salt"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "n_tokens", (F.col("base") + F.col("local")).alias("rank")
    )
    key = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {key}, piece bigint, start bigint, n_tokens bigint, bin_id bigint"
    placed = ranked.mapInArrow(place, fields)
    inside = Window.partitionBy("bin_id").orderBy(F.desc("n_tokens"), "doc_id", "piece")
    total = F.sum("n_tokens").over(Window.partitionBy("bin_id"))
    size = F.array_min(F.filter(F.array(*map(F.lit, capacities)), lambda c: c >= total))
    return placed.select(
        "*",
        (F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
        .alias("position"),
        size.cast("long").alias("capacity"),
    )
