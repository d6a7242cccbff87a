"""Mined negatives against all scores; the multi-index by itself."""

import numpy as np
import pytest
from brute import hard_negatives as by_force
from pyspark.sql import functions as F

from pulselog.llm import hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, score double, cell int, codes string"


def mined(spark, rows, every=5):
    table = spark.createDataFrame([(*r, 0.5, 3, "x") for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives.mine(table, F.col("vec_id") % every == 0).collect()))


def clustered(rng, n, width=12, clusters=6, spread=0.05):
    centres = rng.normal(size=(clusters, width))
    at = rng.integers(0, clusters, n)
    points = centres[at] + spread * rng.normal(size=(n, width))
    return [(k, int((at[k] + (rng.random() < 0.3)) % 4), points[k].tolist()) for k in range(n)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_all_scores(spark, spread):
    rows = clustered(np.random.default_rng(3), 400, spread=spread)
    assert mined(spark, rows) == sorted(by_force(rows, 5))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    flat = [0.5, 0.25, -0.125, 1.0]
    rows = [
        (0, 1, flat), (10, 1, flat), (1, 1, flat), (2, 1, flat), (3, 2, flat), (4, 2, [0.25] * 4),
        (5, 2, [x / 2 for x in flat]), (5, 2, [x / 2 for x in flat]), (0, 1, flat),
        (6, None, flat), (None, 2, flat), (7, 2, None), (8, 2, [nan, 1.0, 1.0, 1.0]),
        (9, 2, [1.0, None, 1.0, 1.0]), (11, 2, [inf, 1.0, 1.0, 1.0]), (12, 2, [0.5]), (13, 2, []),
        (15, 3, [-1.0] * 4), (16, 3, [1.0, 1.0, 1.0, 1.0]), (20, 4, flat), (25, 5, [0.0] * 4),
        (26, 5, [0.0] * 4),
    ]
    want = sorted(by_force(rows, 5))
    assert mined(spark, rows) == want and len(want) > 10


def test_one_vector_many_times(spark):
    rows = [(k, k % 3, [0.5, 0.5, 0.0, 0.1]) for k in range(300)]
    rows += [(1000 + k, k % 3, [0.3, 0.3, 0.1 * (k % 7), 0.0]) for k in range(60)]
    assert mined(spark, rows, 50) == sorted(by_force(rows, 50))


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5])]) == []


def test_multi_sequence_descends():
    rng = np.random.default_rng(0)
    first, second = rng.normal(size=7), rng.normal(size=5)
    got = list(hard_negatives.multi_sequence(first, second))
    assert [g[0] for g in got] == sorted((g[0] for g in got), reverse=True)
    assert {g[1:] for g in got} == {(i, j) for i in range(7) for j in range(5)}


def test_bounds_hold():
    rng = np.random.default_rng(1)
    points = np.floor(256 * rng.normal(size=(500, 6)))
    centres = hard_negatives.codebook(points[:100].copy(), 8)
    at, away = hard_negatives._nearest(points, centres)
    radii = np.array([away[at == k].max(initial=0) for k in range(len(centres))])
    for query in points[:20]:
        least, most = hard_negatives.bounds(query, centres, radii)
        scores = points @ query
        assert (scores <= most[at]).all() and (scores >= least[at]).all()


def test_certificates_save_cells(spark, monkeypatch):
    """Anchors in tight clusters stop early: far fewer cells are asked for than there are."""
    asked = []
    write = hard_negatives.written

    def counted(df, purpose):
        table = write(df, purpose)
        if purpose == "asked":
            asked.append(table.count())
        return table

    monkeypatch.setattr(hard_negatives, "written", counted)
    rows = clustered(np.random.default_rng(5), 1200, clusters=40, spread=0.01)
    assert mined(spark, rows, 30) == sorted(by_force(rows, 30))
    index, entries = hard_negatives.build(
        hard_negatives.quantised(spark.createDataFrame([(*r, 0.0, 0, "") for r in rows], SCHEMA))
    )
    assert sum(asked) < 0.7 * 2 * 40 * len(index.sizes)
