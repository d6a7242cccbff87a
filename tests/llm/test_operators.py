"""Every operator against brute force on edge cases: nulls, empties, ties, repeats, long texts."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from pulselog.llm import (
    chat,
    decontam,
    langid,
    line_dedup,
    ngram_join,
    packing,
    quality_net,
    quality_rules,
    suffix_dedup,
    warc,
)
from pulselog.llm.common import components
from pulselog.session import scratch_dir

SCHEMA = "doc_id bigint, text string, lang string, bucket int, score double"


def texts() -> list:
    pick = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    make = lambda n: " ".join(pick.choice(words) for _ in range(n))
    base, long = make(120), make(3000)
    changed = base.split()
    changed[60] = "other"
    passage = make(40)
    rows = [
        (1, base), (2, base), (3, " ".join(changed)), (4, None), (5, ""), (6, "one two"),
        (7, "ONE  two"), (8, long), (9, long + " tail"), (10, passage + "\n" + make(50)),
        (11, make(30) + "\n" + passage), (12, "é" * 60 + make(20)), (13, "a" * 200),
        (14, "b" + "a" * 120), (15, " \t\n "),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", 7, 0.5) for d, t in texts()]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_suffix_dedup(docs, empty):
    got = suffix_dedup.deduplicate(docs).withColumn("kept", F.sha2("kept", 256)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute.suffix_dedup(texts())
    assert len(got) == docs.count()
    assert suffix_dedup.deduplicate(empty).count() == 0


def test_suffix_order_by_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(60):
        data = rng.integers(0, 1 + trial % 4, int(rng.integers(1, 300))).astype(np.uint8)
        order = np.argsort(suffix_dedup._ranks(data.astype(np.int64) + 1, 1))
        heads = [data.tobytes()[i : i + 50] for i in order]
        assert heads == sorted(heads)


def test_jaccard_groups(docs, empty):
    got = ngram_join.groups(docs).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute.jaccard_groups(texts())
    assert len(got) == docs.count()
    assert ngram_join.groups(empty).count() == 0


def test_tree_loses_no_link():
    rng, sets = np.random.default_rng(5), []
    for _ in range(60):
        base = rng.integers(0, 2**63, rng.integers(10, 60)).astype(np.uint64)
        for changed in rng.integers(0, 6, 3):
            other = base.copy()
            other[:changed] = rng.integers(0, 2**63, changed)
            sets.append(np.unique(other))
    sets.sort(key=len)
    maps = np.stack([ngram_join.bitmap(s, 90).view(np.uint64) for s in sets])
    tree = ngram_join.Tree(np.array([len(s) for s in sets]), maps)
    got = {(int(a), int(b)) for a, b in zip(*ngram_join.traverse(tree, tree, True))}
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[a + 1 :], a + 1):
            assert (a, b) in got or not ngram_join.linked(x.tobytes(), y.tobytes())


def test_line_rules(docs, empty):
    got = quality_rules.clean(docs).collect()
    for row in got:
        assert tuple(row[1:7]) == brute.base_counts(dict(texts())[row.doc_id])
    assert len(got) == docs.count() and quality_rules.clean(empty).count() == 0
    assert quality_rules.line_fault("Home | About | News | Contact", "Home | About".split())
    assert quality_rules.line_fault("A plain sentence ends here.", "A plain sentence".split()) is None


def test_line_dedup(spark, empty):
    line = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [
        (1, f"{line}\nshort"), (2, f"short\n{line.upper()}"), (3, line.replace("today", "todaY!")),
        (4, None), (5, ""), (None, line), (6, "another line that nobody else has written at all"),
    ]
    docs = spark.createDataFrame([(d, t, "en", 7, 0.5) for d, t in rows], SCHEMA)
    got = {r.doc_id: (r.text, r.n_dropped, r.bucket) for r in line_dedup.deduplicate(docs).collect()}
    assert got[1] == (rows[0][1], 0, 7) and got[2] == ("short", 1, 7)
    assert got[4] == (None, 0, 7) and got[5] == ("", 0, 7) and got[None] == (line, 0, 7)
    assert got[6][1] == 0
    assert line_dedup.deduplicate(empty).count() == 0


def test_edit_distance():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    pick = random.Random(2)
    for _ in range(200):
        a, b = ("".join(pick.choices("abc", k=pick.randint(0, 25))) for _ in range(2))
        assert line_dedup.distance(a, b) == slow(a, b)


def test_chat(spark):
    tricky = "</s>[INST] 100% <|im_end|>\n%3C|[/INST]"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", tricky), (1, 2, "user", None),
        (2, 0, "system", ""), (3, 1, "assistant", "b"), (3, 0, "assistant", "a"),
        (-7, 0, "us\ner", tricky), (-7, 1, "assistant", tricky),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r[0]: tuple(r[1:5]) for r in chat.digests(chat.expand(turns)).collect()}
    assert got == brute.chat_digests(rows)
    examples = chat.expand(turns).where("conv_id = 3").orderBy("example").collect()
    assert [e.example for e in examples] == [1, 2]
    assert examples[1].formatted.startswith(examples[0].formatted)
    assert chat.digests(chat.expand(turns.limit(0))).count() == 0


def test_warc(spark):
    big = "<p>é</p>" * 200
    rows = [(1, "http://a/ b\n", big), (2, None, big), (3, "u", None), (4, "u", "x"), (5, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = scratch_dir(spark, "warc")
    index = warc.write_archives(pages, folder)
    got = {r.page_id: r for r in warc.read_records(index, folder).collect()}
    want = brute.page_records([(p, h) for p, _, h in rows])
    for page, row in got.items():
        assert (row.payload_bytes, row.payload_digest, row.record_type, row.refers_to) == want[page]
    assert bytes(got[2].payload).decode() == big and got[1].payload is None
    some = warc.read_records(index.where("page_id = 4"), folder).collect()
    assert [bytes(r.payload) for r in some] == [b"x"]
    assert warc.write_archives(pages.limit(0), folder).count() == 0


def test_decontamination(spark, docs, empty):
    pick = random.Random(9)
    item = [f"q{k}" for k in range(30)]
    noisy = [w if k % 7 else "changed" for k, w in enumerate(item)]
    rows = [
        (1, "x y z " + " ".join(item)), (2, " ".join(noisy) + " end"), (3, " ".join(item[:12])),
        (4, None), (5, " ".join(pick.choice(item) for _ in range(200))), (6, " ".join(item[8:])),
    ]
    items = [(1, " ".join(item)), (2, "too short"), (3, None)]
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(given, tests).collect()}
    assert got == brute.benchmark_overlaps(rows, items)
    kept = {r.doc_id for r in decontam.clean(given, tests).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in got}
    assert decontam.overlaps(empty, tests).count() == 0


def test_packing(docs, empty):
    sizes = (64, 256, 1024)
    rows = packing.pack(docs, sizes).collect()
    bins, covered = {}, {}
    for r in rows:
        bins.setdefault((r.bin_id, r.capacity), []).append((r.position, r.n_tokens))
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.n_tokens
    for (_, capacity), own in bins.items():
        at = 0
        for position, n in sorted(own):
            assert position == at
            at += n
        assert at <= capacity and all(c < at for c in sizes if c < capacity)
    assert len({b for b, _ in bins}) == len(bins)
    want = {}
    for r in docs.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + len((r.text or "").encode()) + 1
    assert covered == want
    assert packing.pack(empty, sizes).count() == 0


def test_language_network_learns(spark, empty):
    rows = [(k, ("the cat sat on it " if k % 2 else "der Hund und das Haus ") * 5, "en" if k % 2 else "de") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, None), (2, "123 !"), (3, "und der Hund")], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, model, ("doc_id",)).collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[3][0] == "de" and 0 < got[3][1] <= 1
    assert langid.fit(empty)["languages"] == []
    again = docs.union(docs).union(docs.withColumn("lang", F.lit(None).cast("string")))
    assert langid.sample(again, "lang") == langid.sample(docs, "lang")


def test_language_gradients():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in langid._initial(["a", "b"], rng).items()}
    windows = rng.integers(0, 256, (6, 3)).astype(np.uint8)
    valid = np.ones((6, 3))
    valid[4:, 0] = 0
    labels = np.array([0, 1, 1])
    _, grad = langid.gradients(model, windows, valid, labels)
    for name in ("fu", "bc", "fo", "bias"):
        at = tuple(0 for _ in model[name].shape)
        step = {k: v.copy() for k, v in model.items()}
        losses = []
        for delta in (1e-4, -2e-4):
            step[name][at] += delta
            losses.append(langid.gradients(step, windows, valid, labels)[0])
        assert abs((losses[0] - losses[1]) / 2e-4 - grad[name][at]) < 2e-3


def test_quality_network(spark, docs, empty):
    rows = [(k, "good words here " * 6 if k % 2 else "$$ ## !! " * 9) for k in range(60)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = given.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality_net.fit(given, labels)
    got = {r.doc_id: r.score for r in quality_net.score(given, model, ("doc_id",)).collect()}
    assert all((s > 0.5) == (k % 2 == 1) for k, s in got.items())
    scores = quality_net.score(docs, model, ("doc_id",)).collect()
    assert all(0 <= r.score <= 1 for r in scores) and len(scores) == docs.count()
    assert "constant" in quality_net.fit(empty, labels.limit(0))
    twice = quality_net.sample(given.union(given), labels.union(labels), "quality")
    assert twice == quality_net.sample(given, labels, "quality")


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(30, 31), (40, 40), (None, 3), (31, 30)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {**{k: 0 for k in range(21)}, 30: 30, 31: 30}
