"""Helpers that several operators share: Arrow text, rolling hashes, packed exchanges, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulselog.session import release_shuffles, scratch_dir

BASE = 0x9E3779B97F4A7C15
MIX = 0x94D049BB133111EB


def written(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, stored in the shared folder: its lineage ends here."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of a number's text, modulo ``divisor``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_spans(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of up to ``limit`` bytes each (or one longer row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def powers_of_base(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverses modulo 2**64, for at least ``count`` places."""
    if len(_HELD[0]) >= count:
        return _HELD[0], _HELD[1]
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        out = np.empty(max(count, MOST_HELD), np.uint64)
        out[0], have = 1, 1
        while have < len(out):
            step = min(have, len(out) - have)
            out[have : have + step] = out[:step] * np.uint64(pow(base, have, 1 << 64))
            have += step
        both.append(out)
    # Those of a very long text are not kept.
    if count <= MOST_HELD:
        _HELD[:] = both
    return both[0], both[1]


MOST_HELD = 1 << 18
_HELD = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
_BYTE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x1D8E4E27C47D124F))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte * BASE**i modulo 2**64, and inverse powers, for ``span_hashes``."""
    n = len(data)
    powers, inverses = powers_of_base(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:n], out=sums[1:])
    return sums, inverses


def span_hashes(hashes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans hash equally wherever they start."""
    sums, inverses = hashes
    return mixed((sums[stop] - sums[start]) * inverses[start] + (stop - start).astype(np.uint64))


def packed(buckets: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket with all its fixed-width records as one binary, field by field.

    Records keep their order within a bucket; equal neighbours in a field compress well then.
    """
    order = np.argsort(buckets, kind="stable")
    buckets, records = buckets[order], records[order]
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else []
    stops = [*starts[1:], len(buckets)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(buckets[starts].astype(np.int32) if len(buckets) else [], pa.int32()),
            pa.array([_columns(records[i:j]) for i, j in zip(starts, stops)], pa.binary()),
        ],
        ["bucket", "blob"],
    )


def _columns(records: np.ndarray) -> bytes:
    names = records.dtype.names
    return b"".join(records[n].tobytes() for n in names) if names else records.tobytes()


def unpacked(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    """The records of ``packed`` binaries, one after another."""
    counts = [len(b) // kind.itemsize for b in blobs]
    out, at = np.empty(sum(counts), kind), 0
    for blob, n in zip(blobs, counts):
        start = 0
        for name in kind.names or (None,):
            field = kind[name] if name else kind
            view = out[name] if name else out
            view[at : at + n] = np.frombuffer(blob, field, n, start)
            start += n * field.itemsize
        at += n
    return out


PACKED = "bucket int, blob binary"


def by_bucket(df: DataFrame, function, schema: str) -> DataFrame:
    """Runs ``function(records) -> RecordBatch``-like over all records of each bucket."""

    def group(table: pa.Table) -> pa.Table:
        return function(table["bucket"][0].as_py(), table["blob"].to_pylist())

    return df.groupBy("bucket").applyInArrow(group, schema)


def buckets_for(df: DataFrame, column: str, each: int) -> int:
    """Buckets so that one gets about ``each`` bytes of the column: follows the input."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // each))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the bigint columns ``a``, ``b``: the smallest node that is reachable.

    Alternating star contraction: each round rewires every node to the smallest neighbour known,
    so paths shorten geometrically. Rounds are cut by tables in the shared folder.
    Null ends and loops are no edges; nodes without an edge do not appear.
    """
    edges = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = written(edges.where("u is not null and v is not null and u <> v").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("u"), F.col("v")))
        nearest = both.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        # Large star: larger neighbours move to the smallest neighbour.
        large = (
            edges.join(nearest, edges.u == nearest.n)
            .select("v", F.least("m", "u").alias("u"))
            .distinct()
        )
        # Small star: a node and its smaller neighbours move to the smallest of them.
        lowest = large.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        small = large.join(lowest, large.v == lowest.n).select("v", "u", "m")
        small = small.select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u"))
        edges = written(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
                edges.select("u", "u").distinct()
            )
        seen = now


def tag(column: str, last: bool = False) -> Column:
    """A text column as key without nulls, in bytewise order; null comes first, or last."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("~" if last else "-"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``before``: what earlier rows of the same ``group`` add up to in sorted batches."""
    held_group, held = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch["group"].dictionary_encode()
        ids = names.indices.to_numpy()
        amounts = batch["amount"].to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        before = np.cumsum(amounts) - amounts
        before -= np.repeat(before[starts], np.diff(np.r_[starts, len(ids)]))
        if batch["group"][0].as_py() == held_group:
            before[: starts[1] if len(starts) > 1 else None] += held
        held_group = batch["group"][-1].as_py()
        held = before[-1] + amounts[-1]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "before"]
        )


def prefix_sums(rows: DataFrame, order: tuple[str, ...], purpose: str) -> DataFrame:
    """``rows`` with ``before`` and ``total``: sums of ``amount`` over earlier rows and all rows.

    Sums run within ``group`` (a text without nulls) by ``order``, and ``amount`` is a bigint.
    Rows are range-sorted, so a group of any size spreads over tasks: each adds up its own rows,
    and the sums of earlier tasks come from a table of one row for each task and group in it.
    Rows alike in all of ``order`` may fall to several tasks too. Null sorts first.
    """
    place = F.monotonically_increasing_id()
    stored = written(rows, f"{purpose}-rows").withColumn("tie", place)
    dealt = stored.repartitionByRange("group", *order, "tie")
    dealt = dealt.sortWithinPartitions("group", *order, "tie").drop("tie")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"`{n}` {k}" for n, k in dealt.dtypes)
    summed = written(dealt.mapInArrow(_running, f"{schema}, before bigint"), f"{purpose}-runs")
    parts = summed.groupBy("group", "part").agg(F.sum("amount").alias("part_sum"))
    same = Window.partitionBy("group")
    offsets = parts.select(
        "group",
        "part",
        (F.sum("part_sum").over(same.orderBy("part")) - F.col("part_sum")).alias("offset"),
        F.sum("part_sum").over(same).alias("total"),
    )
    joined = summed.join(written(offsets, f"{purpose}-offsets"), ["group", "part"])
    before = (F.col("before") + F.col("offset")).alias("before")
    return joined.select(*rows.columns, before, "total")
