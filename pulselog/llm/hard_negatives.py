"""Hard negatives through an inverted multi-index over integer vectors.

Vectors are cut into two halves with a codebook each; a cell is a pair of codewords. An anchor's
score with any row of a cell is at most the sum of two half-bounds, each the score with the
codeword plus the anchor's length times the codeword's radius. The multi-sequence heap gives an
anchor's cells in descending order of that sum. Cells are visited in rounds: each anchor asks for
its next cells, these are scored exactly, and it is done once its lists are certified, that is when no cell
left can hold a row that belongs there. Nothing is approximate: an anchor without a certificate
goes on to the last cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselog.llm.common import written

#: Codewords of a half, and the rows (least hashes of their ids) that the codebooks are fitted on.
CODES = 16
SAMPLE_ROWS = 8192
STEPS = 8
#: Cells of the first round; each later one visits four times as many as all before.
FIRST_CELLS = 24
#: Most rows of a cell and most anchors that meet in one group; with few rows, groups are smaller
#: so that a cell spreads over tasks.
BLOCK_ROWS = 8192
LEAST_ROWS = 64
BLOCK_ANCHORS = 512

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score, in percent of the positive's.
WINDOW = (30, 90)
#: Components up to here keep scores exact as doubles and as longs.
LARGEST = 1 << 20

#: Smallest id, score: what stands for nothing found.
NONE = -(1 << 62)


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, codes): the rows that take part, with components floor(256 * x).

    Rows with a null id, label or vector, or with a null or non-finite component, don't.
    """
    x = F.col("embedding")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    code = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("int"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
    small = F.forall(x, lambda c: F.abs(c) < LARGEST // SCALE)
    checked = F.when(small, code).otherwise(
        F.raise_error(F.lit(f"components must lie within {LARGEST // SCALE}"))
    )
    return rows.where(sound).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), checked.alias("codes")
    )


def _matrix(codes: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    offsets = codes.offsets.to_numpy()
    values = codes.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return values[offsets[0] : offsets[-1]].reshape(-1, width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, column] = values[offsets[0] : offsets[-1]]
    return out


def codebook(points: np.ndarray, codes: int) -> np.ndarray:
    """Codewords by k-means, started on points far from one another."""
    if not len(points) or not points.shape[1]:
        return np.zeros((1, points.shape[1]))
    centres = points[:1]
    away = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < codes and away.max() > 0:
        centres = np.vstack([centres, points[away.argmax()]])
        away = np.minimum(away, ((points - centres[-1]) ** 2).sum(1))
    for _ in range(STEPS):
        nearest = _nearest(points, centres)[0]
        for k in range(len(centres)):
            if (nearest == k).any():
                centres[k] = points[nearest == k].mean(0)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = (points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T
    at = squares.argmin(1)
    return at, np.sqrt(((points - centres[at]) ** 2).sum(1))


def bounds(query: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Least and largest score of a half with any row of each codeword."""
    middle, reach = centres @ query, np.sqrt(query @ query) * radii
    slack = 1e-9 * (np.abs(middle) + reach) + 1e-6  # for rounding
    return np.stack([middle - reach - slack, middle + reach + slack])


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of codewords in descending order of the sum of their half-bounds, lazily."""
    by_first, by_second = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[by_first[0]] + second[by_second[0]]), 0, 0)]
    seen = {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, int(by_first[i]), int(by_second[j])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(by_first) and b < len(by_second) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (-(first[by_first[a]] + second[by_second[b]]), a, b))


class MultiIndex:
    """Codebooks, radii and the cells that hold rows; what the tasks need to name an anchor's cells."""

    def __init__(self, width: int, centres: list[np.ndarray]):
        self.width, self.centres = width, centres
        self.radii = [np.zeros(len(c)) for c in centres]
        self.sizes: dict[int, int] = {}

    def halves(self, points: np.ndarray) -> list[np.ndarray]:
        return [points[:, : self.width // 2], points[:, self.width // 2 :]]

    def cell(self, i, j):
        return i * len(self.centres[1]) + j

    def ordered(self, query: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(largest score, least score, cell) of the cells that hold rows, best first."""
        sides = [bounds(h[0], c, r) for h, c, r in zip(self.halves(query[None]), self.centres, self.radii)]
        for most, i, j in multi_sequence(sides[0][1], sides[1][1]):
            if self.cell(i, j) in self.sizes:
                yield most, sides[0][0][i] + sides[1][0][j], self.cell(i, j)


ENTRIES = "vec_id bigint, label bigint, codes array<int>, cell int, away double, away2 double"


def build(rows: DataFrame) -> tuple[MultiIndex, DataFrame]:
    """The index and its rows by cell. Codebooks are fitted on ``SAMPLE_ROWS`` rows; all rows enter."""
    rows = written(rows, "vectors")
    width = rows.agg(F.max(F.size("codes"))).first()[0] or 0
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label").limit(SAMPLE_ROWS).toArrow()
    index = MultiIndex(width, [])
    points = _matrix(sample["codes"].cast(pa.list_(pa.int32())), width)
    index.centres = [codebook(h.copy(), CODES) for h in index.halves(points)]
    index.radii = [np.zeros(len(c)) for c in index.centres]

    def enter(batches):
        for batch in batches:
            halves = index.halves(_matrix(batch["codes"], width))
            (i, near), (j, near2) = (_nearest(h, c) for h, c in zip(halves, index.centres))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(index.cell(i, j), pa.int32()), pa.array(near), pa.array(near2)],
                ["vec_id", "label", "codes", "cell", "away", "away2"],
            )

    entries = written(rows.mapInArrow(enter, ENTRIES), "cells")
    cells = entries.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("away").alias("away"), F.max("away2").alias("away2")
    )
    known = MultiIndex(width, index.centres)
    for cell, n, away, away2 in cells.collect():  # at most CODES**2 rows
        i, j = divmod(cell, len(index.centres[1]))
        known.sizes[cell] = n
        known.radii[0][i] = max(known.radii[0][i], away)
        known.radii[1][j] = max(known.radii[1][j], away2)
    return known, entries


def _asked(index: MultiIndex, begin: int, end: int):
    """Requests of open anchors for cells ``begin`` to ``end`` of their order.

    ``floor`` and ``roof`` say which scores an anchor still wants. Cells that can't hold any are
    left out: those above the roof one by one, and below the floor the order ends.
    """

    def ask(batches):
        for batch in batches:
            vectors = _matrix(batch["codes"], index.width)
            floors, roofs = batch["floor"].to_numpy(), batch["roof"].to_numpy()
            who, cells = [], []
            for k, query in enumerate(vectors):
                for turn, (most, least, cell) in enumerate(index.ordered(query)):
                    if turn >= end or most < floors[k]:
                        break
                    if turn >= begin and least <= roofs[k]:
                        who.append(k)
                        cells.append(cell)
            taken = batch.take(pa.array(who, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"]
            )

    return ask


def _left(index: MultiIndex, end: int):
    """Adds ``next``: the most that any cell from ``end`` on can give an anchor."""

    def look(batches):
        for batch in batches:
            found = []
            for query in _matrix(batch["codes"], index.width):
                rest = (most for turn, (most, _, _) in enumerate(index.ordered(query)) if turn >= end)
                found.append(next(rest, -np.inf))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "next"]
            )

    return look


HITS = "anchor_id bigint, slot int, score bigint, vec_id bigint"


def _scored(width: int, same_label: bool, most: int):
    """Best rows of a cell's block for each anchor that asks: by slot, score and id.

    A slot is a window of scores; ``lows`` and ``highs`` hold an anchor's windows.
    """

    def score(asked: pa.Table, entries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if asked.num_rows and entries.num_rows:
            entries = entries.sort_by("vec_id")
            ids, labels = entries["vec_id"].to_numpy(), entries["label"].to_numpy()
            rows, queries = _matrix(entries["codes"], width), _matrix(asked["codes"], width)
            own = asked["label"].to_numpy()
            windows = zip(asked["lows"].to_pylist(), asked["highs"].to_pylist())
            everything = np.rint(queries @ rows.T).astype(np.int64)
            anchors = asked["anchor_id"].to_numpy()
            for scores, anchor, label, (lows, highs) in zip(everything, anchors, own, windows):
                fits = (labels == label) & (ids != anchor) if same_label else labels != label
                fits &= (scores >= min(lows)) & (scores <= max(highs))
                at = np.flatnonzero(fits)
                at = at[np.argsort(-scores[at], kind="stable")]  # ties stay by id
                falling = -scores[at]
                for slot, (low, high) in enumerate(zip(lows, highs)):
                    start = np.searchsorted(falling, -high, "left")
                    stop = min(np.searchsorted(falling, -low, "right"), start + most)
                    out += [(anchor, slot, scores[k], ids[k]) for k in at[start:stop]]
        columns = list(zip(*out)) or [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array(np.array(c, np.int64)).cast(k) for c, k in zip(columns, kinds)],
            names=[f.split()[0] for f in HITS.split(", ")],
        )

    return score


def _best(hits: DataFrame, most: int) -> DataFrame:
    """The first ``most`` hits of each anchor and slot; local ones are cut before the shuffle."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def search(
    index: MultiIndex, entries: DataFrame, anchors: DataFrame, same_label: bool, most: int
) -> DataFrame:
    """The first ``most`` rows by score, then id, within each window of each anchor.

    ``anchors``: anchor_id, label, codes, lows, highs (arrays of bounds, a slot each). Returns
    anchor_id, slot, score, vec_id, rank.
    """
    cells = len(index.sizes)
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_rows = min(BLOCK_ROWS, max(LEAST_ROWS, sum(index.sizes.values()) // (4 * tasks)))
    begin, end = 0, FIRST_CELLS
    found = entries.sparkSession.createDataFrame([], f"{HITS}, rank int")
    names = [*anchors.columns]
    schema = ", ".join(f"{n} {k}" for n, k in anchors.dtypes)
    ends = F.array_min("lows").cast("double").alias("floor"), F.array_max("highs").cast("double").alias("roof")
    still = anchors.select("*", *ends)
    full = f"{schema}, floor double, roof double"
    while begin < cells:
        asked = written(still.mapInArrow(_asked(index, begin, end), f"{full}, cell int"), "asked")
        # A cell's rows and its askers are dealt in blocks; each pair of blocks meets once. The
        # counts by cell are CODES**2 rows at most.
        by_cell = asked.groupBy("cell").agg(F.count("*").alias("n"))
        parts = by_cell.select("cell", F.ceil(F.col("n") / BLOCK_ANCHORS).cast("int").alias("parts"))
        sizes = entries.groupBy("cell").agg(F.count("*").alias("n"))
        blocks = sizes.select("cell", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
        shape = F.broadcast(written(parts.join(blocks, "cell"), "shape"))
        dealt = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = asked.join(shape, "cell").select(
            "anchor_id", "label", "codes", "lows", "highs", "cell",
            dealt("anchor_id", "parts").alias("part"), copies("blocks").alias("block"),
        )
        right = entries.join(shape, "cell").select(
            "vec_id", "label", "codes", "cell",
            dealt("vec_id", "blocks").alias("block"), copies("parts").alias("part"),
        )
        key = ("cell", "part", "block")
        hits = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
            _scored(index.width, same_label, most), HITS
        )
        found = written(_best(found.drop("rank").unionByName(hits), most), "hits")
        begin, end = end, end * 5
        if begin >= cells:
            break
        # A window is certified when it is full of scores that no cell left can reach, or when
        # no cell left can reach the window. The others go on from their worst score so far.
        last = found.where(F.col("rank") == most).select(
            "anchor_id", "slot", F.col("score").alias("worst")
        )
        ahead = still.select("anchor_id", "codes", "lows").mapInArrow(
            _left(index, begin), "anchor_id bigint, codes array<int>, lows array<bigint>, next double"
        )
        slots = ahead.select("anchor_id", "next", F.posexplode("lows").alias("slot", "low"))
        slots = slots.join(last, ["anchor_id", "slot"], "left")
        least = F.greatest("low", F.coalesce("worst", F.lit(NONE)))
        wanted = F.when(F.col("next") >= least, least).otherwise(F.lit(-NONE))
        slots = slots.select("anchor_id", F.struct("slot", wanted.alias("low")).alias("window"))
        slots = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list("window")).alias("w"))
        still = still.drop("lows").join(slots.select("anchor_id", F.col("w.low").alias("lows")), "anchor_id")
        still = still.select(*names, F.array_min("lows").cast("double").alias("floor"), "roof")
        still = written(still.where(F.col("floor") < float(-NONE)), "open")
        if still.isEmpty():
            break
    return found


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """For each anchor and positive the hardest negatives: their ranks, ids and scores.

    ``rows``: vec_id, label, embedding; ``is_anchor`` is a condition on vec_id. Positives are an
    anchor's first five other ids of its label; negatives the first ten rows of other labels
    with scores within 30 to 90 percent of the positive's. Scores are integer inner products,
    ties go to the smaller id. An anchor without a positive or a negative has no rows; a positive
    with a score below zero has no negatives. Shorter vectors count as ending in zeros. Repeated
    rows are candidates each, an anchor counts once. Other columns are ignored; an empty table
    gives no rows.
    """
    index, entries = build(quantised(rows))
    anchors = entries.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id")).agg(
        F.min(F.struct("label", "codes")).alias("own")
    )
    everything = F.array(F.lit(NONE))
    anchors = written(anchors.select("anchor_id", "own.*"), "anchors")
    wide = anchors.select("*", everything.alias("lows"), F.array(F.lit(-NONE)).alias("highs"))
    positives = search(index, entries, wide, True, POSITIVES).select(
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        (F.col("rank") - 1).alias("slot"),
    )
    positives = written(positives.where("positive_score >= 0"), "positives")
    listed = F.sort_array(F.collect_list(F.struct("slot", "positive_score")))  # at most POSITIVES
    windows = positives.groupBy("anchor_id").agg(listed.alias("positives"))
    low, high = WINDOW
    windows = windows.selectExpr(
        "anchor_id",
        f"transform(positives, p -> ({low} * p.positive_score + 99) div 100) AS lows",
        f"transform(positives, p -> ({high} * p.positive_score) div 100) AS highs",
    )
    windows = written(anchors.join(windows, "anchor_id"), "windows")
    negatives = search(index, entries, windows, False, NEGATIVES)
    return negatives.join(positives, ["anchor_id", "slot"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
