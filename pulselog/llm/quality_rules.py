"""Line-first cleaning: rules judge single lines, then documents by what the lines cost them."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
TERMINAL = tuple(".!?…:;\"'”’»)]}。！？")
SEPARATOR = re.compile(r"(?:^|\s)(?:[|>»·•/]|::)(?=\s|$)")
BOILERPLATE = re.compile(
    r"all rights reserved|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)"
    r"|accept (?:all )?cookies|enable javascript|click here|read more|sign (?:in|up)|log ?in"
    r"|subscribe to|powered by|lorem ipsum|skip to (?:main )?content|back to top"
    r"|licensed under|spdx-license-identifier|copyright (?:\(c\)|©|\d{4})",
    re.IGNORECASE,
)
#: A line of so many words needs an end mark.
SENTENCE_WORDS = 4
#: A document may lose this share of its word characters to failed lines.
MAX_LOST = 0.4


def line_fault(line: str, words: list[str]) -> str | None:
    """The first rule that a line with words fails; None for a good line."""
    n = len(words)
    if len(SEPARATOR.findall(line)) >= max(2, n // 6):
        return "navigation"
    if BOILERPLATE.search(line) and n <= 30:
        return "boilerplate"
    if 3 * sum(line.count(c) for c in SYMBOLS) > n:
        return "symbols"
    if n >= SENTENCE_WORDS:
        if not line.rstrip().endswith(TERMINAL):
            return "punctuation"
        if line.count("!!") * 3 > n:
            return "punctuation"
        letters = sum(map(str.isalpha, line))
        if letters >= 20 and sum(map(str.isupper, line)) > 0.6 * letters:
            return "shouting"
    return None


def repeated(words: list[str], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    code, size = ids[:n], len(known)
    for k in range(1, width):
        if size * len(known) >= 1 << 62:
            values, code = np.unique(code, return_inverse=True)
            size = len(values)
        code, size = code * len(known) + ids[k : k + n], size * len(known)
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, np.int64)
    again = np.flatnonzero(counts[inverse] >= 2)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judge(text: str | None) -> tuple:
    """All columns of ``clean`` for one text."""
    text = text or ""
    words = WORD.findall(text)
    seen, duplicates, lost, removed, good = set(), 0, 0, 0, []
    for line in text.split("\n"):
        own = WORD.findall(line)
        if own:
            duplicates += line in seen
            seen.add(line)
            if line_fault(line, own):
                lost += sum(map(len, own))
                removed += 1
                continue
        good.append(line)
    chars = sum(map(len, words))
    again = repeated(words)
    failed = len(words) < 10 or 100 * again > 20 * len(words)
    symbols = sum(text.count(c) for c in SYMBOLS)
    kept = not failed and lost <= MAX_LOST * chars
    return len(words), chars, symbols, duplicates, again, failed, kept, removed, lost, "\n".join(good)


FIELDS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "n_removed_lines": pa.int64(),
    "lost_chars": pa.int64(),
    "clean_text": pa.string(),
}


def clean(docs: DataFrame, keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the counts, the verdict and the text without its failed lines.

    Null is treated as empty text: no words, so it fails. Lines without a word are no lines to
    judge and stay in place. Rows are independent: repeated rows get equal verdicts.
    """
    given = docs.select(*keep, "text")
    names = [f.name for f in given.schema.fields[:-1]]
    kinds = {"int64": "bigint", "bool": "boolean", "string": "string"}
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]]
    fields += [f"{k} {kinds[str(v)]}" for k, v in FIELDS.items()]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = list(zip(*map(judge, part.column(part.num_columns - 1).to_pylist())))
                columns = [pa.array(c, t) for c, t in zip(rows, FIELDS.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*names, *FIELDS])

    return given.mapInArrow(run, ", ".join(fields))
