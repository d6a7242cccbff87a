"""Mixing sources to target weights by systematic sampling.

A source's target follows from its weight. Every document of it expects the same number of copies,
target over size; running sums of these along the source, moved by one random offset, pass whole
numbers, and a document comes once for each that its own step passes. Documents stand by size, so
that a copy more or less is made up for by a neighbour of like size: a source's words differ from
its target by no more than its largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselog.llm.common import prefix_sums, tag, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating; the mix's share of all words; most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"
#: Copies are counted in so many parts: running sums are whole numbers and thus exact.
UNIT = 1 << 24


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _targets(sources: DataFrame, share: float) -> DataFrame:
    """Targets of (group, source_size, weight): shares by weight that stop at ``MOST`` sizes.

    Each round takes out the sources whose share is above and deals what is left anew. Only sums
    over the sources reach the driver.
    """
    limit = F.col("source_size") * F.lit(float(MOST))
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    free, taken = F.lit(True), 0.0
    part, full = 0.0, -1
    while True:
        left = sources.where(free).agg(F.sum("weight")).first()[0]
        part = (budget - taken) / left if left else 0.0
        above = sources.where(F.col("weight") * F.lit(part) > limit)
        row = above.agg(F.count("*"), F.sum(limit)).first()
        if row[0] == full or not left:
            break
        full, taken = row[0], row[1] or 0.0
        free = F.col("weight") * F.lit(part) <= limit
    target = F.when(free, F.col("weight") * F.lit(part)).otherwise(limit)
    return sources.withColumn("target", target)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    seed: str = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, copies.

    Sizes are words; null and empty texts have none and expect no copy. Sources ascend by code
    point, null last as a source of its own; a source without a word gets nothing. Documents of
    one size stand by doc_id, null first. Columns in ``carry`` come along in a struct ``document``,
    where no name can clash; others are ignored. Repeated rows are documents of their own; an
    empty table gives no rows. The offset of a source follows from ``seed`` and its name.
    """
    carried = [F.struct(*carry).alias("document")] if carry else []
    rows = docs.select(
        tag("source", last=True).alias("group"),
        F.col("doc_id"),
        "source",
        words(F.col("text")).alias("size"),
        *carried,
    )
    rows = written(rows, "mix-sizes")
    sources = rows.groupBy("group").agg(F.sum("size").alias("source_size"))
    ranked = sources.select(
        F.col("group").alias("name"),
        "source_size",
        F.lit("").alias("group"),
        F.lit(1).cast("long").alias("amount"),
    )
    ranked = prefix_sums(ranked, ("name",), "mix-sources")
    turn = (F.col("before") % len(weights) + 1).cast("int")
    dealt = F.element_at(F.array(*map(F.lit, weights)), turn)
    ranked = ranked.select(F.col("name").alias("group"), "source_size", dealt.alias("weight"))
    targets = _targets(written(ranked, "mix-weights"), share)
    size = F.greatest("source_size", F.lit(1))
    expected = F.col("target") / size * F.lit(float(UNIT))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "group").cast("binary")), 1, 6), 16, 10)
    targets = targets.select(
        "group",
        "source_size",
        "target",
        F.floor(expected).alias("expected"),
        drawn.cast("long").alias("start"),
    )
    rows = rows.join(written(targets, "mix-targets"), "group")
    amount = F.when(F.col("size") > 0, F.col("expected")).otherwise(F.lit(0).cast("long"))
    rows = prefix_sums(rows.withColumn("amount", amount).drop("expected"), ("size", "doc_id"), "mix")
    passed = lambda at: F.expr(f"({at}) div {UNIT}")
    copies = passed("start + before + amount") - passed("start + before")
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        *["document" for _ in carried],
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row for each copy, numbered from 1 in ``copy``; its columns otherwise."""
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return mixed.where("copies > 0").select("*", copy).drop("copies")
