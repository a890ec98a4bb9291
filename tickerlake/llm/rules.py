"""Operator 10, quality rules: repetition coverage by rolling hashes in numpy.

For several n-gram lengths, the characters inside word n-grams that occur more
than once in the text are marked by a difference array and counted; likewise the
characters of lines that repeat an earlier line. A document fails on too large a
covered share at any length.

Defined results: a null or empty text has no words and fails (fewer than 10
words); repeated rows each get their row; very long texts are handled whole, in
one numpy pass; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickerlake.llm import textvec as V
from tickerlake.llm.common import map_arrow, texts

#: Most allowed share of word characters inside repeated n-grams of each length,
#: of characters in repeated lines, and of symbols per word.
MOST_COVERED = {5: 0.20, 7: 0.18, 10: 0.16}
MOST_DUP_LINE = 0.30
MOST_SYMBOLS = 0.30
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
WINDOW = 5

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, dup_line_share double, covered_5 double, covered_7 double, covered_10 double")


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


SYMBOL, NEWLINE = _table("#*$%&|<>"), _table("\n")


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurs twice or more, is not its key's first occurrence) for each key."""
    if len(keys) == 0:
        z = np.zeros(0, bool)
        return z, z
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    twice, later = np.empty(len(s), bool), np.empty(len(s), bool)
    twice[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return twice, later


def _doc_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))


def covered_words(word: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """For each word, whether it lies in a window of ``size`` words found twice or more in its document."""
    n = len(word)
    doc = _doc_of(first)
    at = np.flatnonzero(np.arange(n) + size <= first[1:][doc]) if n else np.zeros(0, np.int64)
    if len(at) == 0:
        return np.zeros(n, bool)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * V._powers(n, V._BASE), dtype=np.uint64)])
        rolled = V.mix((total[at + size] - total[at]) * V._powers(n, V._INVERSE)[at])
        twice, _ = repeated(V.mix(rolled + doc[at].astype(np.uint64) * V._MIX1))
    edge = np.zeros(n + 1, np.int32)
    hit = at[twice]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(ids: pa.Array, column: pa.Array) -> pa.RecordBatch:
    data, off = V.column_bytes(column)
    docs = len(off) - 1
    start, end, first = V.words(data, off)
    n_words = np.diff(first)
    lead = (data & 0xC0) != 0x80
    word_chars = _per_doc(lead & ~V.SPACE[data], off)
    n_symbols = _per_doc(SYMBOL[data], off)
    chars = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])

    l0, l1, lf = V.words(data, off, NEWLINE)
    full = np.concatenate([[0], np.cumsum(~V.SPACE[data], dtype=np.int64)])
    full = full[l1] > full[l0]
    line_doc = _doc_of(lf)[full]
    l0, l1 = l0[full], l1[full]
    with np.errstate(over="ignore"):
        key = V.mix(V.word_hashes(data, l0, l1) + line_doc.astype(np.uint64) * V._MIX1)
    _, later = repeated(key)
    n_dup_lines = np.bincount(line_doc[later], minlength=docs)
    line_chars = chars[l1] - chars[l0]
    all_line = np.bincount(line_doc, line_chars, docs)
    dup_share = np.bincount(line_doc[later], line_chars[later], docs) / np.maximum(all_line, 1)

    word, doc = V.word_hashes(data, start, end), _doc_of(first)
    size = chars[end] - chars[start]
    share, n_repeat = {}, np.zeros(docs, np.int64)
    for n in MOST_COVERED:
        hit = covered_words(word, first, n)
        share[n] = np.bincount(doc[hit], size[hit], docs) / np.maximum(word_chars, 1)
        if n == WINDOW:
            n_repeat = np.bincount(doc[hit], minlength=docs)
    failed = (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEAT_PERCENT * n_words)
    bad = failed | (dup_share > MOST_DUP_LINE) | (n_symbols > MOST_SYMBOLS * n_words)
    for n, most in MOST_COVERED.items():
        bad |= share[n] > most
    out = [ids, n_words, word_chars, n_symbols, n_dup_lines, n_repeat, failed, ~bad, dup_share, *share.values()]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "dup_line_share", "covered_5", "covered_7", "covered_10"]
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in out], names)


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts, the covered shares and the verdict."""

    def run(batch):
        for piece in V.pieces_of(batch, "text", 1 << 20):
            yield measure(piece.column(0).cast(pa.int64()), piece.column(1))

    return map_arrow(texts(docs), run, SCHEMA)
