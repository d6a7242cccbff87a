"""The join's bitmaps lose no link, and a very common part ships once a size."""

import brute
import numpy as np

from pulselog.llm import ngram_join
from pulselog.llm.common import unpacked


def test_bitmaps_rule_out_no_link():
    rng = np.random.default_rng(11)
    for size in (1, 2, 9, 40, 63, 65, 300):
        base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for less in range(0, 1 + size // 8):
            other = np.unique(np.r_[base[less:], rng.integers(0, 2**63, less // 2).astype(np.uint64)])
            bits = [ngram_join.bitmap(x, max(len(x), 1)).tobytes() for x in (base, other)]
            fits = ngram_join.possible(len(base), bits[0], len(other), bits[1])
            assert fits or not ngram_join.linked(base.tobytes(), other.tobytes())
    assert not ngram_join.possible(0, b"\0" * 8, 0, b"\0" * 8)


def test_a_common_part_ships_once_a_size():
    import pyarrow as pa

    n, rows = 3, 90
    size = np.arange(rows) % 4 + 20
    batch = pa.RecordBatch.from_pydict(
        {"node": np.arange(rows), "size": size, "parts": [b"abcde"] * rows}
    )
    shipped, pairs = [], []
    for out in ngram_join._deal(n)([batch]):
        for bucket, blob in zip(out["bucket"].to_pylist(), out["blob"].to_pylist()):
            if bucket < n:
                shipped += unpacked([blob], ngram_join.PART)["node"].tolist()
            else:
                pairs += unpacked([blob], ngram_join.PAIR).tolist()
    assert shipped == [0, 1, 2, 3]
    assert sorted(pairs) == [(k, k + 4) for k in range(rows - 4)]


def test_many_near_copies_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    texts = {}
    for doc in range(60):
        words = list(base)
        words[int(rng.integers(0, 120))] = f"x{doc}"
        texts[doc] = " ".join(words)
    texts |= {100 + k: " ".join(f"y{k}z{j}" for j in range(30)) for k in range(10)}
    rows = [(k, t) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in ngram_join.groups(docs).collect()}
    assert got == brute.jaccard_groups(rows)
    twice = spark.createDataFrame([*rows, (0, ""), (0, None)], "doc_id bigint, text string")
    assert ngram_join.groups(twice).count() == len(rows) + 2
