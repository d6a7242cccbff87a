"""N-gram Jaccard self-join by signature trees, and the connected groups it links.

A document is its set of word shingles. Two sets of high Jaccard similarity differ in few elements;
so when each set is split by hash into more parts than that, one part is equal in both. Equal parts
are the roots: documents without a shared part cannot reach the overlap and are pruned at once.
Shingle width and least similarity are parameters; ``WORDS`` and ``PERCENT`` are those of op5.

Within a root and size class a signature tree holds the documents: leaves by size, every node with the OR of its
documents' token bitmaps and their range of sizes. Two nodes are traversed together, from the top,
and a pair of nodes is dropped when the largest overlap their bitmaps and sizes allow is too small.
What is left is compared exactly. Before that, neighbours by size in each part are compared, so
the trees need to look only for pairs that those links have not joined already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselog.llm.common import (
    by_bucket,
    components,
    mixed,
    packed,
    prefix_hashes,
    row_spans,
    span_hashes,
    unpacked,
    utf8,
    written,
)

WORDS = 3
#: Link at intersection * 100 >= PERCENT * union.
PERCENT = 90
#: Sizes of one class share their number of parts. Above 100 / percent: a linked pair is in one class.
CLASS = 1.5
LEAF = 16
FANOUT = 8
#: A tree holds up to so many documents; larger roots become several trees, joined in pairs.
TREE = 1024

#: Five bytes of a part's hash deal it out: a chance collision costs a comparison, no result.
KEY = 5
PART = np.dtype([("node", "i8"), ("size", "i4"), ("low", "u4"), ("high", "u1")])
PAIR = np.dtype([("a", "i8"), ("b", "i8")])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WORDS):
    """(row, hash) of the distinct shingles of each row, sorted by both."""
    folded = _FOLD[data]
    space = _SPACE[folded]
    edge, close = np.ones(len(data), bool), np.ones(len(data), bool)
    edge[1:], close[:-1] = space[:-1], space[1:]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    close[offsets[1:][offsets[1:] > 0] - 1] = True
    begin, stop = np.flatnonzero(edge & ~space), np.flatnonzero(close & ~space) + 1
    word = span_hashes(prefix_hashes(folded), begin, stop)
    row = np.searchsorted(offsets, begin, "right") - 1
    n = len(word)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    place = np.arange(n) - first[row]
    left = counts[row] - place
    # Full shingles; a row with fewer words is one shingle of all its words.
    at = np.flatnonzero((left >= width) | ((place == 0) & (counts[row] < width)))
    size = np.minimum(left[at], width)
    h = size.astype(np.uint64)
    for k in range(width):
        here = word[np.minimum(at + k, n - 1)] if n else word
        h = np.where(k < size, mixed(h * np.uint64(0x9E3779B97F4A7C15) + here), h)
    row = row[at]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def required(a, b, percent: int = PERCENT):
    """The least intersection that links sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _classes(sizes: np.ndarray, percent: int = PERCENT):
    """(class, largest size, apt) of sets: their own size class, then the next one, which a set
    enters only if a linked partner may be in it."""
    level = np.floor(np.log(np.maximum(sizes, 1)) / np.log(CLASS) + 1e-9).astype(np.int64)
    for up in (0, 1):
        klass = level + up
        ceiling = np.floor(CLASS ** (klass + 1) + 1e-6).astype(np.int64)
        # The larger set of a linked pair has at most size * 100 / percent elements.
        floor = np.ceil(CLASS**klass - 1e-6).astype(np.int64)
        yield klass, ceiling, (sizes > 0) & ((up == 0) | (sizes * 100 >= percent * floor))


def _parts(row: np.ndarray, h: np.ndarray, sizes: np.ndarray, percent: int = PERCENT):
    """(row, key): hashes of the parts of each row's set, in each of its classes.

    A linked pair differs in fewer elements than there are parts. Parts without an element would be
    equal in many sets: a set that has more other parts than it may differ in leaves them out, as
    one of the others is then equal in every linked partner.
    """
    rows, keys = [], []
    # Parts that stay empty in sets of the largest size, twice as many as on average.
    spare = 2 * np.exp(-(100 + percent) / (2 * (100 - percent)))
    for klass, ceiling, apt in _classes(sizes, percent):
        number = 2 * ceiling * (100 - percent) // (100 + percent) + 1
        number += (number * spare).astype(np.int64)
        take = apt[row]
        r, x = row[take], h[take]
        part = (x >> np.uint64(20)) % number[r].astype(np.uint64)
        base = np.cumsum(np.where(apt, number, 0)) - np.where(apt, number, 0)
        slot = base[r] + part.astype(np.int64)
        total = int(np.where(apt, number, 0).sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, slot, mixed(x))
        owner = np.repeat(np.arange(len(sizes)), np.where(apt, number, 0))
        index = np.arange(total) - base[owner]
        tag = (klass[owner] * 1_000_003 + index).astype(np.uint64)
        held = np.bincount(slot, minlength=total) > 0
        partner = np.minimum(ceiling, sizes * 100 // percent)
        differ = (sizes + partner) * (100 - percent) // (100 + percent)
        enough = np.bincount(owner[held], minlength=len(sizes)) > differ
        sent = held | ~enough[owner]
        keys.append(mixed(sums + mixed(tag))[sent])
        rows.append(owner[sent])
    return np.concatenate(rows), np.concatenate(keys)


FEATURES = "doc bigint, size bigint, low bigint, high bigint, parts binary"


def _features(words: int, percent: int):
    def run(batches):
        for batch in batches:
            doc = batch.column("_doc")
            data, offsets = utf8(batch.column("_text"))
            for i, j in row_spans(offsets, 1 << 20):
                n = j - i
                row, h = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                sizes = np.bincount(row, minlength=n)
                low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                np.add.at(low, row, mixed(h))
                np.add.at(high, row, mixed(h ^ np.uint64(0xA5A5A5A55A5A5A5A)))
                owner, key = _parts(row, h, sizes, percent)
                order = np.argsort(owner, kind="stable")
                owner, key = owner[order], key[order]
                cut = np.searchsorted(owner, np.arange(n + 1))
                short = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, :KEY]).tobytes()
                parts = [short[KEY * cut[k] : KEY * cut[k + 1]] for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(i, n),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.array(parts, pa.binary()),
                    ],
                    ["doc", "size", "low", "high", "parts"],
                )

    return run


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a != b
    a, b = a[apart], b[apart]
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)


def _deal(n: int):
    """Deals parts out to ``n`` buckets, and to ``n`` more the pairs that were found on the way.

    A part may be very common. Documents of one size under one part are paired as a chain here,
    and only the first of them travels on: a task ships each part once for each size.
    """

    def flush(kept):
        own = np.concatenate(kept)
        order = np.lexsort((own["node"], own["size"], own["low"], own["high"]))
        one, two = own[order[:-1]], own[order[1:]]
        again = np.ones(len(two), bool)
        for name in ("size", "low", "high"):
            again &= one[name] == two[name]
        pairs = _distinct_pairs(one["node"][again], two["node"][again])
        first = np.ones(len(own), bool)
        first[order[1:][again]] = False
        own = own[first]
        yield packed(own["low"] % np.uint32(n), own)
        if len(pairs):
            found = np.zeros(len(pairs), PAIR)
            found["a"], found["b"] = pairs[:, 0], pairs[:, 1]
            yield packed(n + (mixed(found["a"].view(np.uint64)) % np.uint64(n)).astype(np.int64), found)

    def run(batches):
        kept, total = [], 0
        for batch in batches:
            parts = batch.column("parts").to_pylist()
            count = [len(p) // KEY for p in parts]
            own = np.zeros(sum(count), PART)
            key = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, KEY)
            own["low"] = np.ascontiguousarray(key[:, :4]).view(np.uint32).ravel()
            own["high"] = key[:, 4]
            own["node"] = np.repeat(batch.column("node").to_numpy(), count)
            own["size"] = np.repeat(batch.column("size").to_numpy(), count)
            kept.append(own)
            total += len(own)
            if total >= 1 << 20:
                yield from flush(kept)
                kept, total = [], 0
        if kept:
            yield from flush(kept)

    return run


def _neighbours(n: int, percent: int):
    """Neighbours by size among the documents that share a part, and the pairs found before."""

    def run(bucket: int, blobs: list[bytes]) -> pa.Table:
        if bucket >= n:
            found = unpacked(blobs, PAIR)
            pairs = _distinct_pairs(found["a"], found["b"])
        else:
            rows = unpacked(blobs, PART)
            key = rows["low"].astype(np.uint64) << np.uint64(8) | rows["high"]
            order = np.lexsort((rows["node"], rows["size"], key))
            key, node, size = key[order], rows["node"][order], rows["size"][order].astype(np.int64)
            # Sizes ascend: a set further on that may link makes all sets between them apt as well.
            apt = (key[1:] == key[:-1]) & (100 * size[:-1] >= percent * size[1:])
            pairs = _distinct_pairs(node[:-1][apt], node[1:][apt])
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            node = batch.column("_doc")
            data, offsets = utf8(batch.column("_text"))
            for i, j in row_spans(offsets, 1 << 20):
                row, h = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                own = [h[cut[k] : cut[k + 1]] for k in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [
                        node.slice(i, j - i),
                        pa.array(np.diff(cut).astype(np.int64)),
                        pa.array([bitmap(x, max(len(x), 1)).tobytes() for x in own], pa.binary()),
                        pa.array([x.tobytes() for x in own], pa.binary()),
                    ],
                    ["node", "size", "bits", "tokens"],
                )

    return run


def possible(a: int, x: bytes, b: int, y: bytes, percent: int = PERCENT) -> bool:
    """Whether sets of sizes a and b with these bitmaps may link."""
    need = required(a, b, percent)
    if min(a, b) < max(need, 1):
        return False
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    # Widths are powers of two: the halves of the wider one fold onto each other.
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    common = int(np.bitwise_count(x & y).sum(dtype=np.int64))
    slack = min(a - int(np.bitwise_count(x).sum(dtype=np.int64)), b - int(np.bitwise_count(y).sum(dtype=np.int64)))
    return common + slack >= need


def _possible(percent: int):
    def run(batches):
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("m", "x", "n", "y")]
            same = pa.array([possible(*row, percent) for row in zip(*columns)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), same], ["a", "b", "same"])

    return run


def linked(x: bytes, y: bytes, percent: int = PERCENT) -> bool:
    """The exact test on two sorted sets of hashes."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    need = required(len(a), len(b), percent)
    if not len(a) or not len(b) or min(len(a), len(b)) < need:
        return False
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum()) >= need


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                both = zip(part.column("x").to_pylist(), part.column("y").to_pylist())
                same = pa.array([linked(x, y, percent) for x, y in both], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), same], ["a", "b", "same"])

    return run


class Tree:
    """Signature tree over documents sorted by size: OR-combined bitmaps and size ranges."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        """``sizes`` ascending; ``bitmaps`` is (documents, words of 64 bits)."""
        self.sizes, self.bitmaps = sizes, bitmaps
        bits = np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        # Levels from the documents up: (smallest size, largest, fewest bits, slack, bitmap).
        # slack: the most tokens that any document has beyond its bits.
        self.levels = [(sizes, sizes, bits, sizes - bits, bitmaps)]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            low, high, fewest, slack, maps = self.levels[-1]
            cut = np.arange(0, len(low), width)
            self.levels.append(
                (
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.minimum.reduceat(fewest, cut),
                    np.maximum.reduceat(slack, cut),
                    np.bitwise_or.reduceat(maps, cut, axis=0),
                )
            )
            width = FANOUT

    def width(self, level: int) -> int:
        return LEAF if level == 1 else FANOUT


def traverse(one: Tree, two: Tree, same: bool, percent: int = PERCENT):
    """(i, j) of the documents that may link, by dual traversal from both roots down.

    Of a document with k bits, those missing in the other node's bitmap are tokens no partner
    there has: the overlap is at most its size less that number. For nodes the largest size,
    the fewest bits and the bits that both bitmaps share give a bound for all pairs below.
    """
    up, down = len(one.levels) - 1, len(two.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        a, b = one.levels[up], two.levels[down]
        keep = [np.zeros(0, bool)]
        for at in range(0, len(i), 4096):
            x, y = i[at : at + 4096], j[at : at + 4096]
            low = np.maximum(a[0][x], -(-percent * b[0][y] // 100))
            fits = (low <= a[1][x]) & (percent * a[0][x] <= 100 * b[1][y])
            common = np.bitwise_count(a[4][x] & b[4][y]).sum(axis=1, dtype=np.int64)
            # Tokens of a document inside the common bits: those bits and its slack.
            most = np.minimum(
                np.minimum(a[1][x], common + a[3][x]), np.minimum(b[1][y], common + b[3][y])
            )
            keep.append(fits & (most >= required(a[0][x], b[0][y], percent)))
        keep = np.concatenate(keep)
        i, j = i[keep], j[keep]
        if up == 0 and down == 0:
            break
        # Descend on the side that stands higher; on both if they stand alike.
        deeper_one, deeper_two = up >= down and up > 0, down >= up and down > 0
        for side, deeper in ((0, deeper_one), (1, deeper_two)):
            if not deeper:
                continue
            tree, level = (one, up) if side == 0 else (two, down)
            width = tree.width(level)
            node = i if side == 0 else j
            first = node * width
            number = np.minimum(width, len(tree.levels[level - 1][0]) - first)
            again = np.repeat(np.arange(len(node)), number)
            child = np.repeat(first, number) + np.arange(len(again)) - np.repeat(
                np.cumsum(number) - number, number
            )
            i, j = (child, j[again]) if side == 0 else (i[again], child)
        up, down = up - deeper_one, down - deeper_two
        if same and up == down:
            # Mirrored pairs of one tree are the same pair.
            ordered = i <= j
            i, j = i[ordered], j[ordered]
    if same:
        i, j = i[i != j], j[i != j]
    return i, j


SIGNED = "root bigint, class bigint, node bigint, component bigint, size bigint, bits binary"


def bitmap(tokens: np.ndarray, largest: int) -> np.ndarray:
    """A bit for each token's hash; as wide for all sets of a class, about eight bits a token."""
    words = 1 << max(0, int(np.ceil(np.log2(8 * largest / 64))))
    out = np.zeros(words * 64, np.uint8)
    out[(tokens >> np.uint64(7)) % np.uint64(words * 64)] = 1
    return np.packbits(out)


def _sign(percent: int):
    """Each document's signature in each of its classes."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                tokens = np.frombuffer(row["tokens"], np.uint64)
                for klass, largest, apt in _classes(np.array([len(tokens)]), percent):
                    if apt[0]:
                        bits = bitmap(tokens, int(largest[0])).tobytes()
                        own = row["root"], int(klass[0]), row["node"], row["component"]
                        rows.append((*own, len(tokens), bits))
            names = [x.split()[0] for x in SIGNED.split(", ")]
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def _traverse_root(percent: int):
    """Candidate pairs of different groups between two trees (or within one) of a root."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "ascending"), ("node", "ascending")])
        left, right = table["left"][0].as_py(), table["right"][0].as_py()
        sides = []
        for tree in (left, right):
            own = table.filter(pc.equal(table["tree"], tree))
            bits = np.frombuffer(b"".join(own["bits"].to_pylist()), np.uint64)
            if not own.num_rows:
                return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
            grown = Tree(own["size"].to_numpy(), bits.reshape(own.num_rows, -1))
            sides.append((grown, own["node"].to_numpy(), own["component"].to_numpy()))
        (one, name, group), (two, other, others) = sides
        i, j = traverse(one, two, left == right, percent)
        apart = group[i] != others[j]
        a, b = name[i[apart]], other[j[apart]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(each document's size and ``node``, the component of each linked node).

    Documents with equal sets are one node, named by their smallest doc_id.
    """
    if percent * CLASS <= 100:
        raise ValueError(f"percent has to be above {100 / CLASS:.0f}")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(
        F.col("doc_id").cast("long").alias("_doc"), F.coalesce("text", F.lit("")).alias("_text")
    )
    features = written(named.mapInArrow(_features(words, percent), FEATURES), "sets")
    sets = features.where("size > 0 and doc is not null").groupBy("low", "high", "size").agg(
        F.min("doc").alias("node")
    )
    classes = written(
        features.select("doc", "size", "low", "high").join(sets, ["low", "high", "size"], "left"),
        "classes",
    )
    first = classes.where("doc = node").select("node", "low", "high").distinct()
    nodes = features.withColumnRenamed("doc", "node").join(first, ["node", "low", "high"])
    nodes = nodes.dropDuplicates(["node", "low", "high"]).select("node", "size", "parts")
    near = nodes.mapInArrow(_deal(4 * parts), "bucket int, blob binary")
    near = written(by_bucket(near, _neighbours(4 * parts, percent), "a bigint, b bigint").distinct(), "near")
    roots = written(components(near).withColumnRenamed("component", "root"), "roots")
    # A doc_id may stand for several sets: each of them is compared.
    tokens = named.join(roots.select(F.col("node").alias("_doc")), "_doc").select("_doc", "_text")
    tokens = written(
        tokens.mapInArrow(_sets(words), "node bigint, size bigint, bits binary, tokens binary"), "tokens"
    )

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs that their bitmaps, an eighth of the sets, do not rule out."""
        left = tokens.select(F.col("node").alias("a"), F.col("size").alias("m"), F.col("bits").alias("x"))
        right = tokens.select(F.col("node").alias("b"), F.col("size").alias("n"), F.col("bits").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "m", "x", "n", "y")
        both = both.mapInArrow(_possible(percent), "a bigint, b bigint, same boolean")
        return both.where("same").select("a", "b").distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
        right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        both = both.mapInArrow(_verify(percent), "a bigint, b bigint, same boolean")
        return written(both.where("same").select("a", "b").distinct(), "links")

    found = verified(likely(near))
    groups = components(found)
    labelled = roots.join(groups, "node", "left").select(
        "node", "root", F.coalesce("component", "node").alias("component")
    )
    counted = labelled.groupBy("root").agg(
        F.min("component").alias("x"), F.max("component").alias("y")
    )
    # Roots whose documents are one group already have nothing to add.
    torn = labelled.join(counted.where("x <> y").select("root"), "root")
    torn = torn.join(tokens.select("node", "tokens"), "node")
    signed = torn.select("root", "node", "component", "tokens").mapInArrow(_sign(percent), SIGNED)
    signed = written(signed, "signatures")
    trees = signed.groupBy("root", "class").agg(F.ceil(F.count("*") / TREE).cast("int").alias("n"))
    torn = signed.join(trees, ["root", "class"])
    torn = torn.withColumn("tree", F.pmod(F.xxhash64("node"), "n").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")
    torn = torn.select("*", other).select(
        *(x.split()[0] for x in SIGNED.split(", ")),
        "tree",
        F.least("tree", "other").alias("left"),
        F.greatest("tree", "other").alias("right"),
    )
    rest = torn.groupBy("root", "class", "left", "right").applyInArrow(
        _traverse_root(percent), "a bigint, b bigint"
    )
    rest = written(rest.where("a <> b").distinct().join(near, ["a", "b"], "left_anti"), "rest")
    more = verified(rest)
    if not more.isEmpty():
        groups = components(found.union(more))
    return classes, groups


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (smallest doc_id reachable).

    Documents link when their sets of shingles of ``words`` words have ``percent`` / 100 of their
    union in common.
    Null and empty texts have no shingle and are linked with nothing. Repeated rows get equal
    rows; rows that share a doc_id count as one document for links. A null doc_id is linked with
    nothing and has a null component. Other columns play no part.
    """
    classes, joined = links(docs, words, percent)
    return classes.join(joined, "node", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "node", "doc").alias("component_id"),
    )
