"""Vectorised text helpers for the Arrow tasks: words, word hashes and shingles of a whole batch at once.

All functions work on the UTF-8 bytes of a batch of texts laid end to end, so
their cost is a few numpy passes per byte whatever the number of documents.
Hashes are 64-bit and depend on the bytes alone (fixed seeds): two executors, or
two runs, always agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = h + U64(salt)
        h = (h ^ (h >> U64(30))) * _MIX1
        h = (h ^ (h >> U64(27))) * _MIX2
        return h ^ (h >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64), 0x51ED27)


def is_space_table() -> np.ndarray:
    """True for the bytes that separate words: blank, and tab to carriage return."""
    t = np.zeros(256, bool)
    t[0x20] = True
    t[0x09:0x0E] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


SPACE, LOWER = is_space_table(), lower_table()


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column laid end to end; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def pieces_of(batch: pa.RecordBatch, text: str, most: int = 4 << 20):
    """Cut a batch into row ranges of about ``most`` text bytes (one long text stays whole)."""
    column = batch.column(batch.schema.get_field_index(text))
    _, off = column_bytes(column)
    start, n = 0, len(column)
    while start < n:
        stop = int(np.searchsorted(off, off[start] + most, "right"))
        stop = min(n, max(start + 1, stop - 1))
        yield batch.slice(start, stop - start)
        start = stop


def words(data: np.ndarray, off: np.ndarray, separators: np.ndarray = SPACE):
    """(start, end, first) of every word: byte ranges, and for each document the index of its first word.

    Words never run over a document's end. ``first`` has one entry more than documents.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    begins[edge] |= inside[edge]
    ends[edge - 1] |= inside[edge - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, off)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        with np.errstate(over="ignore"):
            out[1:] = U64(base)
            np.cumprod(out, out=out)
    return out


_INVERSE = pow(_BASE, -1, 1 << 64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, independent of where the word stands."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(len(data), _BASE), out=total[1:])
        back = _powers(len(data) + 1, _INVERSE)
        h = (total[end] - total[start]) * back[start]
        return mix(h + (end - start).astype(np.uint64) * _MIX2)


def shingle_hashes(word: np.ndarray, first: np.ndarray, size: int = 5):
    """(hashes, doc offsets) of all word shingles, in order, repeats included.

    A document with fewer than ``size`` words (but some) has its whole word
    sequence as its one shingle; one without words has none.
    """
    n_words = np.diff(first)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    off = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    out = np.zeros(off[-1], np.uint64)
    if off[-1] == 0:
        return out, off
    with np.errstate(over="ignore"):
        if len(word) >= size:
            rolled = word[:len(word) - size + 1].copy()
            for j in range(1, size):
                rolled *= U64(_BASE)
                rolled += word[j:len(word) - size + 1 + j]
            full = n_words >= size
            at = np.ones(off[-1], bool)
            at[off[:-1][~full & (n_words > 0)]] = False
            begin = np.repeat(first[:-1][full] - off[:-1][full], count[full]) + np.flatnonzero(at)
            out[at] = mix(rolled[begin], size)
        for i in np.flatnonzero((n_words > 0) & (n_words < size)):
            h = np.zeros(1, np.uint64)
            for w in word[first[i]:first[i + 1]]:
                h = h * U64(_BASE) + w
            out[off[i]] = mix(h, int(n_words[i]))[0]
    return out, off
