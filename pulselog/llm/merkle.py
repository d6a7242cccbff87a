"""Merkle manifest of a table: digests by source, proofs, and the check of what lies there now.

Every row is a leaf; each source's leaves form a tree of fan-out three, and the sources' roots form
one more. Trees are cut into superblocks of equal height, so no task holds more than ``SPAN`` nodes
of a level, whatever a source's size. Upwards each superblock hands over its root alone. Downwards
superblocks are cogrouped with the outer nodes on their way to the root: there the local
reduction, the rest of each proof, and the fold of the claimed leaf happen together.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselog.llm.common import prefix_sums, tag, written

FAN = 3
#: Levels of one superblock, and its largest number of nodes.
HEIGHT = 6
SPAN = FAN**HEIGHT

#: The tree over the sources' roots; a source's name starts with a mark.
TOP = ""

NODES = "tree string, place bigint, digest string, total bigint"
# A node's way up: the members of each run from its superblock's root on, itself as null, and a
# row without member that carries the roots.
PATHS = "tree string, place bigint, step int, spot int, member string, subroot string, root string"


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(sized, F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def _reduced(digests: list[str], total: int) -> list[list[str]]:
    """The levels of a superblock; that of a tree with no other one ends with its root."""
    levels = [digests]
    while len(levels) <= HEIGHT if total > SPAN else len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([digest_of("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)])
    return levels


def _runs(levels: list[list[str]], place: int) -> list[tuple[int, list[str]]]:
    """Own spot and run of the node at ``place``, level by level."""
    steps = []
    for nodes in levels[:-1]:
        start = place - place % FAN
        steps.append((place - start, nodes[start : start + FAN]))
        place //= FAN
    return steps


def _outer(paths: pd.DataFrame) -> list[tuple[int, list[str]]]:
    """The same for the levels above a superblock."""
    steps: dict[int, list] = {}
    members = paths[paths["step"] >= 0].sort_values(["step", "spot"])
    for step, member in zip(members["step"], members["member"]):
        steps.setdefault(step, []).append(member)
    hole = lambda run: next(k for k, m in enumerate(run) if m is None)
    return [(hole(run), run) for run in steps.values()]


def _siblings(steps: list[tuple[int, list[str]]]) -> list[str]:
    return [m for spot, run in steps for k, m in enumerate(run) if k != spot]


def _folded(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    for spot, run in steps:
        digest = digest_of("".join([*run[:spot], digest, *run[spot + 1 :]]))
    return digest


def _root(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("place")
    total = int(nodes["total"].iloc[0])
    root = _reduced(nodes["digest"].tolist(), total)[-1][0]
    return pd.DataFrame(
        {
            "tree": nodes["tree"].iloc[:1],
            "place": nodes["block"].iloc[:1],
            "digest": [root],
            "total": [-(-total // SPAN)],
        }
    )


def _roots(outer: pd.DataFrame, top: str) -> tuple[str | None, str]:
    """The roots that a superblock's outer rows name; without such rows its own is the root."""
    heads = outer[outer["step"] < 0]
    return (heads["subroot"].iloc[0], heads["root"].iloc[0]) if len(heads) else (None, top)


def _descend(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The way up of every node of a superblock."""
    nodes = nodes.sort_values("place")
    levels = _reduced(nodes["digest"].tolist(), int(nodes["total"].iloc[0])) if len(nodes) else []
    rows = []
    if levels:
        above = _outer(outer)
        subroot, root = _roots(outer, levels[-1][0])
        for k, (tree, place, digest) in enumerate(zip(nodes["tree"], nodes["place"], nodes["digest"])):
            known = (digest if tree == TOP else subroot, root)
            rows.append((tree, place, -1, None, None, *known))
            for step, (spot, run) in enumerate([*_runs(levels, k), *above]):
                for at, member in enumerate(run):
                    own = None if at == spot else member
                    rows.append((tree, place, step, at, own, *known))
    return pd.DataFrame(rows, columns=[f.split()[0] for f in PATHS.split(", ")])


def _finish(with_proofs: bool):
    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("place")
        rows = []
        if len(nodes):
            levels = _reduced(nodes["digest"].tolist(), int(nodes["total"].iloc[0]))
            above = _outer(outer)
            subroot, root = _roots(outer, levels[-1][0])
            beyond = _siblings(above)
            columns = zip(nodes["doc_id"], nodes["digest"], nodes["claim"])
            for k, (doc_id, digest, claim) in enumerate(columns):
                inner = _runs(levels, k)
                proof = _siblings(inner) + beyond
                folded = _folded(_folded(claim, inner), above)
                row = (doc_id, digest, subroot, root, digest_of("".join(proof)), folded)
                rows.append((*row, folded == root, *([proof] if with_proofs else [])))
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return pd.DataFrame(rows, columns=names + ["proof"] * with_proofs)

    return finish


def _in_blocks(nodes: DataFrame):
    return nodes.select("*", F.expr(f"place div {SPAN}").alias("block"))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes: the given ones, their superblocks' roots, and so on to one node a tree."""
    tables = [nodes]
    while True:
        grouped = _in_blocks(tables[-1].select(*[f.split()[0] for f in NODES.split(", ")]))
        roots = written(grouped.groupBy("tree", "block").applyInPandas(_root, NODES), "merkle")
        tables.append(roots)
        if (roots.agg(F.max("total")).first()[0] or 0) <= 1:
            return tables


def _cogrouped(nodes: DataFrame, outer: DataFrame):
    nodes, outer = _in_blocks(nodes), outer.withColumnRenamed("place", "block")
    return nodes.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))


def manifest(docs: DataFrame, found_text: Column, with_proofs: bool = False) -> DataFrame:
    """Digests, proofs and their check for every row of ``documents``.

    Leaves are digests of doc_id, source, lang, n_chars and text. A source's leaves ascend by
    doc_id, null first, rows of one doc_id by digest; sources ascend bytewise, null first.
    ``found_text`` is the text that lies there now: its leaf, folded with the siblings of the
    recorded one, gives ``folded_root``, and ``verified`` says whether that is the root.
    ``with_proofs`` adds ``proof``, the siblings from the leaf to the root.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Repeated rows are
    leaves of their own. Nulls in any column are values of their own; an empty text differs from
    null. Other columns are ignored; an empty table gives no rows.
    """
    fixed = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        tag("source").alias("group"),
        F.lit(1).cast("long").alias("amount"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(*fixed, F.col("text")).alias("digest"),
        leaf_digest(*fixed, found_text).alias("claim"),
    )
    leaves = prefix_sums(leaves, ("doc_id", "digest"), "leaves")
    leaves = leaves.select(
        F.col("group").alias("tree"),
        F.col("before").alias("place"),
        "digest",
        "total",
        F.col("doc_id").cast("string").alias("doc_id"),  # whole also beside nulls in pandas
        "claim",
    )
    sources = _levels(leaves)
    subroots = sources[-1].select(
        F.lit(TOP).alias("group"), F.lit(1).cast("long").alias("amount"), "tree", "digest"
    )
    subroots = prefix_sums(subroots, ("tree",), "subroots")
    subroots = subroots.select(
        F.col("group").alias("tree"),
        F.col("before").alias("place"),
        "digest",
        "total",
        F.col("tree").alias("member"),
    )
    tops = _levels(subroots)
    paths = docs.sparkSession.createDataFrame([], PATHS)
    for nodes in reversed(tops[:-1]):
        names = nodes.select("tree", "place", "digest", "total")
        paths = written(_cogrouped(names, paths).applyInPandas(_descend, PATHS), "merkle")
    # A source's root is a node of the top tree, and its way up is that of the source's superblock.
    members = subroots.select("place", F.col("member").alias("tree"))
    paths = paths.drop("tree").join(members, "place").withColumn("place", F.lit(0).cast("long"))
    paths = paths.select(*[f.split()[0] for f in PATHS.split(", ")])
    for nodes in reversed(sources[1:-1]):
        paths = written(_cogrouped(nodes, paths).applyInPandas(_descend, PATHS), "merkle")
    schema = (
        "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean" + ", proof array<string>" * with_proofs
    )
    found = _cogrouped(leaves, paths).applyInPandas(_finish(with_proofs), schema)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
