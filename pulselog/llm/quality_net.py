"""Quality classifier: a byte-level convolutional network, written and trained in numpy.

Filters slide over overlapping chunks that cover the whole text; each filter keeps its strongest
answer within a chunk. The chunks' answers are averaged and combined into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselog.llm.common import row_spans, utf8

FILTERS = 12
WIDTH = 8
CHUNK = 256
OVERLAP = 32
#: Bounds of the training sample: labelled documents, and chunks from each.
SAMPLE_DOCS = 4000
SAMPLE_CHUNKS = 6
STEPS = 900
BATCH = 64
Model = dict


def chunk_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of the chunks: every CHUNK - OVERLAP bytes, at least one for each row."""
    stride = CHUNK - OVERLAP
    lengths = np.diff(offsets)
    count = np.maximum(1, -(-(lengths - OVERLAP) // stride))
    row = np.repeat(np.arange(len(lengths)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, offsets[row] + k * stride


def _bytes(data, offsets, row, start):
    """(chunks, CHUNK + WIDTH - 1) symbols; 256 stands beyond the text."""
    pos = start[:, None] + np.arange(CHUNK + WIDTH - 1)
    inside = pos < np.minimum(offsets[row + 1], start + CHUNK)[:, None]
    if not len(data):
        return np.full(pos.shape, 256, np.int16)
    return np.where(inside, data[np.minimum(pos, len(data) - 1)], 256).astype(np.int16)


def _answers(model: Model, columns: np.ndarray, f: int) -> np.ndarray:
    """(positions, chunks): filter ``f`` at every second position."""
    total = np.take(model["conv"][0, f], columns[:CHUNK:2])
    for j in range(1, WIDTH):
        total += np.take(model["conv"][j, f], columns[j : j + CHUNK : 2])
    return total


def _columns(symbols: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(symbols.T).astype(np.intp)


def _pooled(model: Model, symbols: np.ndarray) -> np.ndarray:
    """(filters, chunks): the strongest answer of each filter."""
    columns = _columns(symbols)
    best = [_answers(model, columns, f).max(axis=0) for f in range(FILTERS)]
    return np.tanh(np.stack(best) + model["bias"])


def _placed(model: Model, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_pooled``, and where each filter answered."""
    columns, best, where = _columns(symbols), [], []
    for f in range(FILTERS):
        answers = _answers(model, columns, f)
        at = answers.argmax(axis=0)
        best.append(answers[at, np.arange(len(at))])
        where.append(2 * at)
    return np.tanh(np.stack(best) + model["bias"]), np.stack(where)


def _head(model: Model, features: np.ndarray) -> np.ndarray:
    hidden = np.tanh(model["w1"] @ features + model["b1"])
    return hidden, 1 / (1 + np.exp(-(model["w2"] @ hidden + model["b2"])))[0]


def train(texts: list[list[bytes]], labels: list[int], steps: int = STEPS, seed: int = 3) -> Model:
    """Fits to texts, each a list of chunks; without both classes, the share of label 1."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    if len(set(labels)) < 2:
        return {"constant": share}
    rng = np.random.default_rng(seed)
    model = {
        "conv": rng.normal(0, 0.15, (WIDTH, FILTERS, 257)),
        "bias": np.zeros((FILTERS, 1)),
        "w1": rng.normal(0, 0.3, (8, FILTERS)),
        "b1": np.zeros((8, 1)),
        "w2": rng.normal(0, 0.3, (1, 8)),
        "b2": np.full((1, 1), np.log(share / (1 - share))),
    }
    model = {k: v.astype(np.float32) for k, v in model.items()}
    model["conv"][:, :, 256] = 0
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    labels = np.array(labels)
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    for step in range(1, steps + 1):
        # Half the batch from each class; the weights restore the true shares.
        pick = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        y = labels[pick]
        weight = np.where(y == 1, share, 1 - share) * 2
        chunks = [c for i in pick for c in texts[i]]
        row = np.repeat(np.arange(BATCH), [len(texts[i]) for i in pick])
        offsets = np.cumsum([0, *map(len, chunks)])
        data = np.frombuffer(b"".join(chunks), np.uint8)
        symbols = _bytes(data, offsets, np.arange(len(chunks)), offsets[:-1])
        answers, where = _placed(model, symbols)
        size = np.bincount(row, minlength=BATCH)
        mean = np.zeros((BATCH, FILTERS), np.float32)
        np.add.at(mean, row, answers.T)
        mean = (mean / size[:, None]).T
        hidden, p = _head(model, mean)
        error = ((p - y) * weight / BATCH)[None].astype(np.float32)
        grad = {"w2": error @ hidden.T, "b2": error.sum(axis=1, keepdims=True)}
        back = (model["w2"].T @ error) * (1 - hidden * hidden)
        grad["w1"], grad["b1"] = back @ mean.T, back.sum(axis=1, keepdims=True)
        back = (model["w1"].T @ back / size)[:, row] * (1 - answers * answers)
        grad["bias"] = back.sum(axis=1, keepdims=True)
        grad["conv"] = np.zeros_like(model["conv"])
        at, f = np.arange(len(chunks)), np.arange(FILTERS)[:, None]
        for j in range(WIDTH):
            np.add.at(grad["conv"][j], (f, symbols[at, where + j]), back)
        grad["conv"][:, :, 256] = 0
        rate = 0.01 * (1 - step / (steps + 1)) + 0.0005
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            scale = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-5
            model[k] = (model[k] - rate * first[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return model


def probabilities(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One probability for each row, from all its bytes."""
    rows = len(offsets) - 1
    if "constant" in model:
        return np.full(rows, model["constant"])
    row, start = chunk_starts(offsets)
    total = np.zeros((rows, FILTERS), np.float32)
    for a in range(0, len(row), 512):
        r = row[a : a + 512]
        answers = _pooled(model, _bytes(data, offsets, r, start[a : a + 512]))
        np.add.at(total, r, answers.T)
    mean = total / np.bincount(row, minlength=rows)[:, None]
    return _head(model, mean.T.astype(np.float32))[1].astype(np.float64)


def sample(docs: DataFrame, labels: DataFrame, label: str) -> list:
    """(doc_id, label, chunks) of at most SAMPLE_DOCS labelled documents.

    Rows that repeat a doc_id and label count as one document, the least by chunks.
    """
    ids = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(SAMPLE_DOCS)
    )
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

    def cut(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            row, start = chunk_starts(offsets)
            chunks = []
            for i in range(batch.num_rows):
                own = start[row == i]
                own = own[np.linspace(0, len(own) - 1, min(len(own), SAMPLE_CHUNKS)).astype(int)]
                chunks.append([data[s : min(s + CHUNK, offsets[i + 1])].tobytes() for s in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(chunks, pa.list_(pa.binary()))],
                ["doc_id", "label", "chunks"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    out = chosen.select("doc_id", "label", "text").mapInArrow(
        cut, f"doc_id {key}, label int, chunks array<binary>"
    )
    rows = out.groupBy("doc_id", "label").agg(F.min("chunks").alias("chunks")).collect()
    return sorted((r.doc_id, r.label, [bytes(c) for c in r.chunks]) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learns ``label`` (0 or 1, others ignored) of (doc_id, label) rows from a bounded sample."""
    rows = sample(docs, labels, label)
    return train([c for _, _, c in rows], [y for _, y, _ in rows])


def score(docs: DataFrame, model: Model, keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """``keep`` columns and ``score`` of each row's whole ``text``, null and empty ones included.

    Null scores as empty text does. Rows are independent of each other and of other columns.
    """
    given = docs.select(*keep, "text")
    names = [f.name for f in given.schema.fields[:-1]]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in given.schema.fields[:-1])

    def rate(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            out = [
                probabilities(model, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for i, j in row_spans(offsets, 1 << 20)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate([np.zeros(0), *out]))],
                [*names, "score"],
            )

    return given.mapInArrow(rate, fields + "score double")
