"""Brute-force versions of the operators, without Spark, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def suffix_dedup(docs: list[tuple[int, str | None]], length: int = 50) -> dict[int, tuple]:
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    first: dict[bytes, int] = {}
    for doc, text in sorted(docs, key=lambda r: r[0]):
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            first.setdefault(data[i : i + length], doc)
    out = {}
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingle_set(text: str | None, width: int = 3) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def jaccard_groups(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest reachable doc_id)."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common: Counter = Counter()
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 90 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def base_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            marked.update(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(marked), failed


def chat_digests(turns: list[tuple]) -> dict:
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256)."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    chats = defaultdict(list)
    for conv, turn, role, text in turns:
        chats[conv].append((turn, role, text or ""))
    out = {}
    for conv, own in chats.items():
        own.sort(key=lambda t: t[0])
        loss = "".join(t for _, r, t in own if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in own)
        out[conv] = (len(own), sha(whole), len(loss), sha(loss))
    return out


def page_records(pages: list[tuple]) -> dict:
    """page_id -> (payload_bytes, digest, type, refers_to)."""
    last: dict[bytes, int] = {}
    for page, html in pages:
        data = (html or "").encode()
        last[data] = max(page, last.get(data, page))
    out = {}
    for page, html in pages:
        data = (html or "").encode()
        to = last[data] if len(data) >= 1000 and last[data] != page else None
        kind = "response" if to is None else "revisit"
        out[page] = (len(data), hashlib.sha1(data).hexdigest(), kind, to)
    return out


def benchmark_overlaps(docs, items, stretch: int = 20, agree: float = 0.8) -> set:
    """(doc_id, item_id) of every substitution-tolerant overlap on any alignment."""
    import math

    found = set()
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    tests = [(i, split(t)) for i, t in items]
    where: dict[str, list] = defaultdict(list)
    for k, (_, words) in enumerate(tests):
        for p, w in enumerate(words):
            where[w].append((k, p))
    for doc, text in docs:
        words = split(text)
        diagonals = defaultdict(set)
        for p, w in enumerate(words):
            for k, q in where.get(w, ()):
                diagonals[k, p - q].add(q)
        for (k, _), equal in diagonals.items():
            item, own = tests[k]
            width = min(stretch, len(own))
            need = math.ceil(width * agree)
            if len(own) >= 7 and len(equal) >= need:
                for s in range(len(own) - width + 1):
                    if sum(q in equal for q in range(s, s + width)) >= need:
                        found.add((doc, item))
                        break
    return found


def merkle(rows, found):
    """rows: (doc_id, source, lang, n_chars, text); found: texts that lie there now."""
    from hashlib import sha256

    def h(*parts):
        return sha256("".join(parts).encode()).hexdigest()

    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(leaves):
        """Root, and each leaf's way up as (digests before, digests behind)."""
        ways, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
        while len(nodes) > 1:
            for leaf, i in enumerate(at):
                run = nodes[i - i % 3 : i - i % 3 + 3]
                ways[leaf].append((run[: i % 3], run[i % 3 + 1 :]))
            nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
            at = [i // 3 for i in at]
        return nodes[0], ways

    groups = {}
    for row, text in zip(rows, found):
        fixed = [enc(v) for v in row[:4]]
        groups.setdefault(row[1], []).append((row[0], h(*fixed, enc(row[4])), h(*fixed, enc(text))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(tree([r[1] for r in groups[name]]))
    root, tops = tree([t[0] for t in trees])
    out = []
    for name, (subroot, ways), top in zip(names, trees, tops):
        for (doc_id, leaf, claim), way in zip(groups[name], ways):
            for left, right in way + top:
                claim = h(*left, claim, *right)
            proof = [s for left, right in way + top for s in left + right]
            out.append((doc_id, leaf, subroot, root, h(*proof), claim, claim == root, proof))
    return out


def hard_negatives(rows, anchors_every):
    """rows: (vec_id, label, vector); anchors are ids divisible by ``anchors_every``."""
    import math

    kept = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    anchors = {}
    for vec_id, label, code in kept:
        if vec_id % anchors_every == 0:
            anchors[vec_id] = min(anchors.get(vec_id, (label, code)), (label, code))
    out = []
    for anchor, (own, query) in anchors.items():
        scored = [
            (-sum(a * b for a, b in zip(query, code)), vec_id, label)
            for vec_id, label, code in kept
            if vec_id != anchor
        ]
        scored.sort()
        for minus, positive, _ in [s for s in scored if s[2] == own][:5]:
            fits = [s for s in scored if s[2] != own and -30 * minus <= -100 * s[0] <= -90 * minus]
            for rank, (score, negative, _) in enumerate(fits[:10], 1):
                out.append((anchor, positive, rank, negative, -minus, -score))
    return out


def mix_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """sizes: words by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, budget, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        part = budget / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * part > most * sizes[s]}
        if not above:
            return target | {s: weight[s] * part for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            budget -= target[s]
        open_ -= above
    return target
