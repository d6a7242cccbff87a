"""The manifest against a plain recursion over all leaves."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from pulselog.llm import merkle

# Columns named like the operator's own helpers are ignored.
CLASHES = "group string, amount int, digest string, claim string, tree string, place int, total int"
SCHEMA = f"doc_id bigint, source string, lang string, n_chars bigint, text string, {CLASHES}"


def here():
    return F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


def found(row):
    return row[4].replace("\n", "") if row[4] and row[0] is not None and row[0] % 2 == 0 else row[4]


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "g", 1, "d", "c", "t", 5, 6) for r in rows], SCHEMA)
    got = merkle.manifest(docs, here(), with_proofs=True).collect()
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(
        brute.merkle(rows, [found(r) for r in rows]), key=key
    )
    return got


def test_edges(spark):
    rows = [
        (1, "a", "en", 3, "x\ny"), (2, "a", "en", 3, "x\ny"), (2, "a", "en", 3, "x\ny"),
        (2, "a", None, None, "other"), (None, "a", "en", 0, "no\nid"), (4, None, "en", 1, "n\n"),
        (6, "", "en", 0, ""), (8, "-", "en", None, None), (10, "é", "de", 2, "ü\n" * 5),
        (12, "one leaf", "de", 2, "\n"), (-3, "a", "en", 1, "minus"),
        (2**60 + 1, "a", "en", 2, "large\nid"), (14, "long", "en", 1, "line of text\n" * 200_000),
    ]
    got = check(spark, rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].verified and not by_id[4].verified and by_id[6].verified
    assert not by_id[14].verified and by_id[2**60 + 1].verified


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_few_rows(spark, n):
    check(spark, [(k, "s", "en", k, f"t\n{k}") for k in range(n)])


def test_source_of_many_superblocks(spark):
    assert merkle.SPAN < 800
    rows = [(k, "hot" if k % 3 else f"s{k % 5}", "en", k, f"text\n{k}") for k in range(2600)]
    random.Random(1).shuffle(rows)
    check(spark, rows)


def test_many_sources(spark):
    check(spark, [(k, f"s{k % 1500}", "en", k, f"text\n{k}") for k in range(1600)])


def test_same_row_many_times(spark):
    check(spark, [(7, "s", "en", 1, "same\nrow")] * 900 + [(8, "s", "en", 1, "else\n")])


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), here()).count() == 0
