"""Targets against the plain sharing of excess; what the mix takes against its targets."""

import random
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from pulselog.llm import mixing

SCHEMA = "doc_id bigint, source string, text string, size int, group string, target int, amount int"


def mixed(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "g", 2, 3) for r in rows], SCHEMA)
    return mixing.mix(docs, **options)


def check(rows, got):
    sizes, sources = defaultdict(int), defaultdict(list)
    for _, source, text in rows:
        sizes[source] += len((text or "").split())
    want = brute.mix_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        sources[r.source].append(r)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (d, s, len((t or "").split())) for d, s, t in rows
    )
    for source, docs in sources.items():
        taken = sum(r.copies * r.size for r in docs)
        assert abs(taken - want[source]) <= max(r.size for r in docs) + 1e-6 * want[source] + 1e-6


def test_edges(spark):
    long = "word " * 400_000
    rows = [
        (1, "a", "x y z"), (1, "a", "x y z"), (2, "a", None), (3, "a", ""), (None, "a", "no id here"),
        (4, None, "null source"), (5, None, "a\x0bb\x1cc d"), (6, "", "empty name"), (7, "~", "tilde"),
        (8, "words", " \t\n"), (9, "é", "one two three four"), (10, "z", long),
    ]
    docs = [(d, s, t if t != "a\x0bb\x1cc d" else "a bc d") for d, s, t in rows]
    check(docs, mixed(spark, rows).collect())


@pytest.mark.parametrize("seed", range(3))
def test_taken_comes_near_the_targets(spark, seed):
    pick = random.Random(seed)
    rows = [
        (k, "hot" if k % 3 == 0 else f"s{pick.randint(0, 9)}", "w " * int(pick.paretovariate(0.8)))
        for k in range(1500)
    ]
    got = mixed(spark, rows, seed=f"seed {seed}").collect()
    check(rows, got)
    assert sorted(got, key=str) == sorted(mixed(spark, rows, seed=f"seed {seed}").collect(), key=str)


def test_every_document_has_its_chance(spark):
    """Over many offsets a document comes as often as it expects to."""
    rows = [(k, "a" if k < 8 else f"b{k}", "w " * (k % 3 + 1)) for k in range(30)]
    n, seeds = Counter(), 5
    for seed in range(seeds):
        for r in mixed(spark, rows, seed=str(seed)).where("source = 'a'").collect():
            n[r.doc_id] += r.copies
            rate = r.target / r.source_size
    assert all(abs(n[k] / seeds - rate) <= 0.8 for k in range(8))


def test_copies_are_emitted_whole(spark):
    rows = [(k, f"s{k % 4}", f"text {k} " * (k % 5)) for k in range(60)]
    mix = mixed(spark, rows, carry=("text", "size", "target"))
    want = Counter()
    for r in mix.collect():
        want[(r.document.text, r.document.target)] += r.copies
    got = Counter((r.document.text, r.document.target) for r in mixing.emitted(mix).collect())
    assert got == +want
    assert mixing.emitted(mix).agg(F.max("copy")).first()[0] <= 2


def test_empty(spark):
    assert mixed(spark, []).count() == 0
    assert mixed(spark, [(1, "a", None), (2, None, "")]).agg(F.sum("copies")).first()[0] == 0
