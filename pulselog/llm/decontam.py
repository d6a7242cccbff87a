"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A mask looks at some of the words of a short window and ignores the others, so a replaced word at
an ignored place hides nothing. Windows of benchmark items and documents that hash alike under
one mask are hits; each hit fixes an alignment, and the whole item is then compared along it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of a window that a mask looks at. A window of 20 words keeps a hit at most layouts of
#: up to four replaced words.
MASKS = ((0, 1, 2, 4, 5, 6), (0, 1, 3, 5, 6, 7), (0, 2, 3, 6, 8, 9))
#: An overlap: so many aligned words (or the whole item, if shorter), of which this share agrees.
STRETCH = 20
AGREE = 0.8
#: Benchmark seeds up to this many rows are broadcast (24 bytes each); beyond, the join shuffles.
BROADCAST_SEEDS = 1_000_000


def _words(text: Column) -> Column:
    """Hashes of the lower-cased words of a text; null has none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _at(words: str, place: Column) -> Column:
    """The word at a place; null before the first and behind the last."""
    return F.when(place >= 0, F.get(words, place))


def _seeds(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` (with ``words``), each window's ``at`` and its ``seed`` per mask."""
    last = F.size("words") - 1 - min(m[-1] for m in MASKS)
    # No filter on the size: it would be pushed below and split every text once more.
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    rows = rows.select("*", F.explode(places).alias("at"))
    seeds = [
        F.when(
            F.col("at") + mask[-1] < F.size("words"),
            F.xxhash64(F.lit(k), *(F.get("words", F.col("at") + p) for p in mask)),
        )
        for k, mask in enumerate(MASKS)
    ]
    return rows.select("*", F.explode(F.array(*seeds)).alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, agreeing, doc_word): items of which a document holds an overlap.

    ``agreeing`` is the most equal words in a stretch, ``doc_word`` the item's aligned start in
    the document's words. Null or short texts (items under seven words) overlap with nothing.
    Rows with a null doc_id or item_id are left out; repeated rows and ties give one row for each
    pair of ids. Extra columns play no part.
    """
    items = items.where("item_id is not null").select(
        "item_id", _words(F.col("text")).alias("words")
    )
    test = _seeds(items).select(
        "seed", "item_id", F.col("at").alias("item_at"), F.size("words").alias("length")
    )
    small = test.count() <= BROADCAST_SEEDS
    test = F.broadcast(test) if small else test
    words = docs.where("doc_id is not null").select("doc_id", _words(F.col("text")).alias("words"))
    hits = _seeds(words).join(test, "seed")
    start = F.col("at") - F.col("item_at")
    # Only the words along the item go on, never the whole document with every hit.
    along = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length"))
    hits = hits.select("doc_id", "item_id", start.alias("doc_word"), along.alias("own")).distinct()
    items = items.withColumnRenamed("words", "item").distinct()
    hits = hits.join(F.broadcast(items) if small else items, "item_id")
    ahead = F.least(F.col("doc_word"), F.lit(0))
    equal = F.transform(
        "item",
        lambda w, k: F.when(w.eqNullSafe(_at("own", k + ahead)), F.lit(1)).otherwise(F.lit(0)),
    )
    hits = hits.select("doc_id", "item_id", "doc_word", equal.alias("equal"))
    width = F.least(F.size("equal"), F.lit(STRETCH))
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size("equal") - width + 1),
            lambda s: F.aggregate(F.slice("equal", s, width), F.lit(0), lambda a, b: a + b),
        )
    )
    hits = hits.select("doc_id", "item_id", "doc_word", best.alias("agreeing"), width.alias("width"))
    hits = hits.where(F.col("agreeing") >= F.ceil(F.col("width") * AGREE))
    most = F.max(F.struct("agreeing", (-F.col("doc_word")).alias("at"))).alias("most")
    return hits.groupBy("doc_id", "item_id").agg(most).select(
        "doc_id",
        "item_id",
        F.col("most.agreeing").cast("long").alias("agreeing"),
        (-F.col("most.at")).cast("long").alias("doc_word"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, that overlap with no item; null ids are kept."""
    found = overlaps(docs, items).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, docs.doc_id == F.col("_found"), "left_anti")
