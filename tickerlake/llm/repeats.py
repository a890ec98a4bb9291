"""Operator 9, suffix-array dedup: repeated passages by threshold-bounded interval expansion on a BWT.

Every byte covered by a 50-byte string that also starts in a document with a
smaller id is removed. Matches never cross documents.

1. Equal texts are one text: its document with the smallest id stands for it, the
   others are removed whole (if they have 50 bytes at all).
2. Candidates. Of the 16-byte strings in each 50-byte window the one with the
   smallest hash is the window's anchor; equal windows have equal anchors. Anchors
   that only one text holds are dropped: every window of theirs is unique. No repeat is lost.
3. Each remaining anchor is sent, with the bytes of its windows (its context), to the
   bucket of its hash. Contexts that are equal within a task are sent once, with their places.
   Anchors with more places than ``MOST_CONTEXTS`` are a table that is joined with the
   texts' anchors. Contexts of theirs are cut into their
   single windows first, each a context of 50 bytes that goes to the bucket of its own
   hash, so that a common string spreads over many tasks; they are expanded like all others.
4. A bucket joins its distinct contexts to one string, sorts its suffixes, and takes
   their common prefix lengths from the Burrows-Wheeler transform breadth first:
   entries with value l are found by extending those with smaller values
   backwards, by increasing l, and the search stops at 50. What is left unset has at
   least 50 bytes in common with its neighbour: the intervals of repeated windows.
   Each interval's smallest id decides which of its windows go.
5. A document's spans are joined and cut out.

The texts are written once, in the shared folder, as files bucketed by text and id, so that neither the
anchors nor the spans move them again, and copies of a text spread over all buckets. No table stays in the catalog.

Defined results: a null or empty text has 0 bytes and loses none; repeated rows with one
id do not remove each other; a null id counts as the largest; very long texts are
handled whole; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.llm import textvec as V
from tickerlake.llm.common import stored, texts
from tickerlake.session import shared_dir

U64 = np.uint64
#: Bytes of a repeat, and of an anchor.
LEAST, GRAM = 50, 16
WINDOW = LEAST - GRAM + 1
#: Positions handled at once (they fit the processor's cache), and the bits that hold a position.
CHUNK, PLACE_BITS = 1 << 17, 24
#: Anchors a task gathers before it sends them on, anchors per bucket, and context bytes per bucket.
FLUSH_ENTRIES, BUCKET_ENTRIES, BUCKET_BYTES = 500_000, 1_000_000, 1_500_000
FLUSH_BYTES = 3_000_000
#: Places of an anchor above which its windows are sent singly (full contexts would fill a bucket),
#: windows and context bytes expanded at once, and windows per bucket.
MOST_CONTEXTS, EXPANDED, BUCKET_WINDOWS = 16_384, 1_000_000, 500_000
PIECE_BYTES = 1 << 20
NO_ID = (1 << 63) - 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 16 bytes from each position on."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h, size = V._BYTE[data], 1
        while size < GRAM:
            h = h[:len(h) - size] * U64(V._BASE) + h[size:]
            h ^= h >> U64(29)
            size *= 2
        return h * V._MIX2


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of every anchor, in order; windows are 50-byte strings inside a document."""
    keys, firsts, lasts = [], [], []
    n = len(data)
    window = np.zeros(n + 1, np.int32)  # 1 where a window of one document starts
    long = np.flatnonzero(np.diff(off) >= LEAST)
    np.add.at(window, off[long], 1)
    np.add.at(window, off[long + 1] - LEAST + 1, -1)
    window = np.cumsum(window[:-1]) > 0
    low = U64((1 << PLACE_BITS) - 1)
    for a in range(0, n, CHUNK):
        stop = min(n, a + CHUNK + LEAST - 1)
        h = gram_hashes(data[a:stop])
        if len(h) < WINDOW:
            continue
        best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= WINDOW:
            best = np.minimum(best[:len(best) - size], best[size:])
            size *= 2
        if size < WINDOW:
            best = np.minimum(best[:len(best) - (WINDOW - size)], best[WINDOW - size:])
        at = np.flatnonzero(window[a:a + min(len(best), CHUNK)])
        if len(at) == 0:
            continue
        place = (best[at] & low).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(at)]]) - 1
        keys.append(V.mix(h[place[begin]], 31))  # anchors have small hashes: mixed again, they spread evenly over the buckets
        firsts.append(a + at[begin])
        lasts.append(a + at[end])
    if not keys:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(lasts)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ..., size - 1 for each size, one after the other."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(at[-1]) - np.repeat(at[:-1], sizes)


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of ``data`` end to end."""
    return data[np.repeat(start, size) + _runs(size)]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Range of the hash; the global order is cut evenly."""
    return (((keys >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)


# --- anchors that more than one text holds ---------------------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, byte planes apart: their zero planes compress away on the way."""
    step = np.diff(values, prepend=U64(0))
    return step.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(body: bytes) -> np.ndarray:
    step = np.frombuffer(body, np.uint8).reshape(8, -1).T
    with np.errstate(over="ignore"):
        return np.cumsum(np.ascontiguousarray(step).view(np.uint64).ravel(), dtype=np.uint64)


def _shared_rows(keys: np.ndarray, owner: np.ndarray, tids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One task flush: rows for the buckets, and rows of what is already known to be shared.

    A hash that several texts of the flush hold is shared: they are all noted at
    once and one of them stands for them in the bucket. So a bucket gets at most one entry per hash and flush.
    """
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    times = np.diff(np.concatenate([np.flatnonzero(new)[first], [len(new)]]))  # places of each hash
    many = ~first
    many[:-1] |= ~first[1:]
    rows: list[tuple] = []
    lone, whose = keys[first], owner[first]
    cut = np.searchsorted(bucket_of(lone, buckets), np.arange(buckets + 1))
    for b in range(buckets):
        x, y = cut[b], cut[b + 1]
        if x < y:
            used, index = np.unique(whose[x:y], return_inverse=True)
            rows.append((b, _planes(lone[x:y]), np.stack([index, times[x:y]]).astype("<u4").view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes(),
                         tids[used].tobytes()))
    known, mine = keys[many], owner[many]
    order = np.argsort(mine, kind="stable")
    known, mine = known[order], mine[order]
    cut = np.concatenate([[0], np.flatnonzero(mine[1:] != mine[:-1]) + 1, [len(mine)]]) if len(mine) else [0]
    for x, y in zip(cut[:-1], cut[1:]):
        t = tids[mine[x]]
        rows.append((buckets + int(t.view(np.uint64) % U64(buckets)), known[x:y].tobytes(), b"", t.tobytes()))
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                      ["bucket", "keys", "index", "tids"])


def shared_anchors(docs: DataFrame, buckets: int, most: int = MOST_CONTEXTS) -> DataFrame:
    """(tid, keys): per text the hashes of its anchors that another text holds too. ``docs`` has (tid, text).

    Rows without a tid hold (hash, places) of the anchors with more than ``most`` places.
    """

    def emit(batches):
        held, tids, seen, texts_seen = [], [], 0, 0

        def flush():
            keys, owner = map(np.concatenate, zip(*held))
            return _shared_rows(keys, owner, np.concatenate(tids), buckets)

        for batch in batches:
            for piece in V.pieces_of(batch, "text", PIECE_BYTES):
                data, off = V.column_bytes(piece.column(1))
                keys, first, _ = anchors(data, off)
                held.append((keys, texts_seen + np.searchsorted(off, first, "right") - 1))
                tids.append(piece.column(0).to_numpy())
                texts_seen += piece.num_rows
                seen += len(keys)
                if seen >= FLUSH_ENTRIES:
                    # Copies of a text in one flush are one text.
                    yield flush()
                    held, tids, seen, texts_seen = [], [], 0, 0
        if seen:
            yield flush()

    def group(table: pa.Table) -> pa.Table:
        """One row per bucket of texts: the shared keys found here, by text."""
        hot = np.zeros((0, 2), np.uint64)
        if table.column("bucket")[0].as_py() >= buckets:
            tids = [np.frombuffer(t, np.int64)[0] for t in table.column("tids").to_pylist()]
            bodies = table.column("keys").to_pylist()
            keys = np.frombuffer(b"".join(bodies), np.uint64)
            tids = np.repeat(np.array(tids, np.int64), [len(b) // 8 for b in bodies])
        else:
            keys, tids, times = [], [], []
            for k, i, t in zip(*(table.column(c).to_pylist() for c in ("keys", "index", "tids"))):
                keys.append(_unplanes(k))
                index, n = np.ascontiguousarray(np.frombuffer(i, np.uint8).reshape(2, 4, -1).transpose(0, 2, 1)).view("<u4").reshape(2, -1)
                tids.append(np.frombuffer(t, np.int64)[index])
                times.append(n)
            keys, tids, times = np.concatenate(keys), np.concatenate(tids), np.concatenate(times)
            order = np.lexsort((tids, keys))
            keys, tids = keys[order], tids[order]
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            places = np.add.reduceat(times[order], begin, dtype=np.uint64)
            hot = np.stack([keys[begin], places], axis=1)[places > most]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (tids[1:] != tids[:-1])
            keys, tids = keys[new], tids[new]
            same = np.zeros(len(keys) + 1, bool)
            same[1:-1] = keys[1:] == keys[:-1]
            many = same[1:] | same[:-1]
            keys, tids = keys[many], tids[many]
        part = (tids.view(np.uint64) % U64(buckets)).astype(np.int64)
        order = np.lexsort((tids, part))
        keys, tids, part = keys[order], tids[order], part[order]
        cut = np.searchsorted(part, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(cut))
        out = [(b, tids[cut[b]:cut[b + 1]].tobytes(), keys[cut[b]:cut[b + 1]].tobytes()) for b in used]
        if len(hot):
            out.append((buckets, b"", hot.tobytes()))
        cols = list(zip(*out)) if out else [[]] * 3
        return pa.table({"part": pa.array(cols[0], pa.int32()), "tids": pa.array(cols[1], pa.binary()), "keys": pa.array(cols[2], pa.binary())})

    def by_text(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() == buckets:
            return pa.table({"tid": pa.nulls(table.num_rows, pa.int64()), "keys": table.column("keys").cast(pa.binary())})
        tids = np.frombuffer(b"".join(table.column("tids").to_pylist()), np.int64)
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        order = np.lexsort((keys, tids))
        keys, tids = keys[order], tids[order]
        cut = np.concatenate([[0], np.flatnonzero(tids[1:] != tids[:-1]) + 1, [len(tids)]]) if len(tids) else np.zeros(1, np.int64)
        return pa.table({"tid": pa.array(tids[cut[:-1]], pa.int64()),
                         "keys": pa.array([keys[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())})

    rows = docs.select("tid", "text").mapInArrow(emit, "bucket int, keys binary, index binary, tids binary")
    found = rows.groupBy("bucket").applyInArrow(group, "part int, tids binary, keys binary")
    return found.groupBy("part").applyInArrow(by_text, "tid long, keys binary")


def anchor_rows(keys: DataFrame) -> DataFrame:
    """(tid, key) of every packed anchor of a text."""

    def run(batches):
        for batch in batches:
            each = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            if each:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), [len(x) for x in each])),
                                                  pa.array(np.concatenate(each))], ["tid", "key"])

    return keys.filter("tid is not null").select("tid", "keys").mapInArrow(run, "tid long, key long")


def common_anchors(keys: DataFrame) -> DataFrame:
    """(key, places) of the anchors with more places than the limit of ``shared_anchors``."""

    def run(batches):
        for batch in batches:
            pairs = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(0)]]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["key", "places"])

    return keys.filter("tid is null").select("keys").mapInArrow(run, "key long, places long")


# --- repeated windows of a bucket ------------------------------------------------------------------------------------

def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` or more symbols: prefix doubling from 8 packed symbols, re-sorting only what is still tied."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key <<= U64(8)
        key[:n - j] |= text[j:]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.empty(n + 1, np.uint64)
    rank[n] = 0
    size = 8
    while size < depth:
        # A suffix's rank is the place where its group of ties starts, counted from 1.
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0)).astype(np.uint64)
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if len(at) == 0:
            break
        member = order[at]
        key = (rank[member] << U64(32)) | rank[np.minimum(member + size, n)]
        again = np.argsort(key)
        order[at] = member[again]
        key = key[again]
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[at] = fresh
        size *= 2
    return order


def repeat_classes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, class of each entry): entries of one class share at least ``least`` symbols.

    Common prefix lengths come from the Burrows-Wheeler transform breadth first.
    ``back`` lists the transform's entries by symbol: entry k of the suffix order
    is the backward extension of entry back[k]. Neighbours k - 1 and k that begin
    with one symbol differ after l + 1 symbols as soon as an entry with value at
    most l lies between their extensions' origins. Only entries without a value
    stay in the search, and it ends at ``least``.
    """
    n = len(text)
    order = suffix_order(text, least)
    bwt = text[order - 1]
    back = np.argsort(bwt, kind="stable").astype(np.int32)
    begins = np.sort(text, kind="stable")
    unlike = np.ones(n, bool)  # entry has a value so far: it differs from the one before within the level's symbols
    unlike[1:] = begins[1:] != begins[:-1]
    open_ = np.flatnonzero(~unlike).astype(np.int32)
    lo, hi = np.minimum(back[open_ - 1], back[open_]), np.maximum(back[open_ - 1], back[open_])
    beside = hi == lo + 1  # extensions of neighbours: one entry decides, the one at hi
    near, near_hi = open_[beside], hi[beside]
    open_, lo, hi = open_[~beside], lo[~beside], hi[~beside]
    fresh = None  # entries that the last level gave a value: only they can part what was together so far
    for _ in range(least - 1):
        parted = unlike[near_hi]
        found = [near[parted]]
        if len(open_):
            if fresh is None or len(open_) * 16 > n:
                upto = np.cumsum(unlike, dtype=np.int32)
                apart = upto[hi] != upto[lo]
            else:
                apart = np.searchsorted(fresh, hi, "right") != np.searchsorted(fresh, lo, "right")
            found.append(open_[apart])
            open_, lo, hi = open_[~apart], lo[~apart], hi[~apart]
        fresh = np.concatenate(found)
        fresh = np.sort(fresh[~unlike[fresh]])
        if len(fresh) == 0:
            break
        unlike[fresh] = True
        if len(found[0]) * 4 > len(near):
            near, near_hi = near[~parted], near_hi[~parted]
    return order, np.cumsum(unlike) - 1


def window_minimum(body: np.ndarray, size: np.ndarray, ids: np.ndarray, least: int) -> np.ndarray:
    """For every window of every context (end to end), the smallest id among all equal windows."""
    n_windows = size - least + 1
    start = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    text = np.zeros(int((size + 1).sum()), np.uint8)
    symbol = np.zeros(256, np.uint8)
    used = np.flatnonzero(np.bincount(body, minlength=256))
    symbol[used] = np.arange(1, len(used) + 1)
    text[np.repeat(start, size) + _runs(size)] = symbol[body]
    order, cls = repeat_classes(text, least)
    at = np.repeat(start, n_windows) + _runs(n_windows)
    value = np.full(len(text), NO_ID, np.int64)
    value[at] = np.repeat(ids, n_windows)
    low = np.minimum.reduceat(value[order], np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]])))
    out = np.empty(len(text), np.int64)
    out[order] = low[cls]
    return out[at]


def _equal_contexts(body: np.ndarray, size: np.ndarray) -> np.ndarray:
    """128-bit identities (as rows of two integers) of contexts laid end to end."""
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    marks = np.empty((len(size), 2), np.uint64)
    step = 8192  # contexts at once: the hash takes some 40 bytes of memory per byte
    for a in range(0, len(size), step):
        z = min(len(size), a + step)
        part = body[start[a]:start[z - 1] + size[z - 1]]
        at, length = start[a:z] - start[a], size[a:z]
        marks[a:z, 0] = V.word_hashes(part, at, at + length)
        marks[a:z, 1] = V.mix(V.word_hashes(255 - part, at, at + length), 5)
    return marks


def _distinct(marks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the occurrence with the smallest id for each distinct context, distinct context of each occurrence)."""
    order = np.lexsort((ids, marks[:, 1], marks[:, 0]))
    s = marks[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    which = np.empty(len(s), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _span_rows(tid: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list, list]:
    """One packed list of (start, end) per text."""
    order = np.lexsort((start, tid))
    tid, start, end = tid[order], start[order], end[order]
    cut = np.concatenate([[0], np.flatnonzero(tid[1:] != tid[:-1]) + 1, [len(tid)]]) if len(tid) else np.zeros(1, np.int64)
    both = np.stack([start, end], axis=1).astype("<i8")
    return [int(t) for t in tid[cut[:-1]]], [both[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]


def _gone_rows(tid: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> list[tuple]:
    """Spans that a flush decides by itself, as packed rows beside the buckets."""
    return [(buckets + int(np.int64(t).view(np.uint64) % U64(buckets)), np.int64(t).tobytes(), b"", b"", b"", s)
            for t, s in zip(*_span_rows(tid, start, end))]


def _window_spans(tid: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of what single windows cover, touching ones as one."""
    order = np.lexsort((place, tid))
    tid, place = tid[order], place[order]
    new = np.ones(len(tid), bool)
    new[1:] = (tid[1:] != tid[:-1]) | (place[1:] > place[:-1] + LEAST)
    begin = np.flatnonzero(new)
    return tid[begin], place[begin], place[np.append(begin[1:], len(tid))[:len(begin)] - 1] + LEAST


def _window_rows(body: np.ndarray, size: np.ndarray, tid: np.ndarray, ids: np.ndarray, places: np.ndarray, times: np.ndarray,
                 buckets: int, spread: int) -> list[tuple]:
    """The single windows of contexts (end to end) as packed rows, by the window's own hash; of equal windows the smallest id goes on."""
    n = size - LEAST + 1
    at = np.repeat(np.cumsum(size) - size, n) + _runs(n)
    marks = np.empty((len(at), 2), np.uint64)
    marks[:, 0] = V.word_hashes(body, at, at + LEAST)
    marks[:, 1] = V.mix(V.word_hashes(255 - body, at, at + LEAST), 5)
    # Each window stands at every place of its context.
    owner, within = np.repeat(np.arange(len(n)), n), _runs(n)
    many = times[owner]
    window = np.repeat(np.arange(len(at)), many)
    owner = owner[window]
    place = places[(np.cumsum(times) - times)[owner] + _runs(many)] + within[window]
    marks, tid, ids = marks[window], tid[owner], ids[owner]
    start = at[window]
    pick, which = _distinct(marks, ids)
    gone = ids > ids[pick][which]
    out = _gone_rows(*_window_spans(tid[gone], place[gone]), buckets)
    # Of equal windows with equal ids, one goes on per text, with all its places.
    rest = np.flatnonzero(~gone)
    rest = rest[np.lexsort((place[rest], tid[rest], which[rest], bucket_of(marks[rest, 0], spread)))]
    new = np.ones(len(rest), bool)
    new[1:] = (which[rest][1:] != which[rest][:-1]) | (tid[rest][1:] != tid[rest][:-1])
    head = np.flatnonzero(new)
    end = np.concatenate([head, [len(rest)]])
    k = rest[head]
    cut = np.searchsorted(bucket_of(marks[k, 0], spread), np.arange(spread + 1))
    for b in np.flatnonzero(np.diff(cut)):
        x, y = cut[b], cut[b + 1]
        size = np.full(y - x, LEAST)
        out.append((2 * buckets + int(b), tid[k[x:y]].tobytes(), ids[k[x:y]].tobytes(), place[rest[end[x]:end[y]]].tobytes(),
                    np.stack([size, np.diff(end[x:y + 1])]).astype("<u4").tobytes(), gather(body, start[k[x:y]], size).tobytes()))
    return out


def _context_rows(held: list[tuple], buckets: int, spread: int) -> pa.RecordBatch:
    """One task flush of contexts (key, common, text, id, place, size, bytes) as packed rows, one per bucket.

    Contexts of ``common`` anchors go as single windows to ``spread`` buckets of their own.
    """
    keys, common, tid, ids, first, size, body = (np.concatenate([h[i] for h in held]) for i in range(7))
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    pick, which = _distinct(_equal_contexts(body, size), ids)
    # An equal context with a smaller id is here already: all its bytes go, and only that one is sent on.
    gone = ids > ids[pick][which]
    out = _gone_rows(tid[gone], first[gone], (first + size)[gone], buckets)
    # Of equal contexts with equal ids, one goes on per text, with all its places.
    rest = np.flatnonzero(~gone)
    rest = rest[np.lexsort((first[rest], tid[rest], which[rest]))]
    new = np.ones(len(rest), bool)
    new[1:] = (which[rest][1:] != which[rest][:-1]) | (tid[rest][1:] != tid[rest][:-1])
    head = np.flatnonzero(new)
    times = np.diff(np.concatenate([head, [len(rest)]]))
    single = common[rest[head]]
    h = np.flatnonzero(single)
    upto = np.cumsum((size[rest[head[h]]] - LEAST + 1) * times[h] + size[rest[head[h]]])
    for h in np.split(h, np.flatnonzero(np.diff(upto // EXPANDED)) + 1) if len(h) else []:
        k = rest[head[h]]
        places = first[rest[np.repeat(head[h], times[h]) + _runs(times[h])]]
        out += _window_rows(gather(body, start[k], size[k]), size[k], tid[k], ids[k], places, times[h], buckets, spread)
    bucket = np.where(single, buckets, bucket_of(keys[rest[head]], buckets))
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        h = order[cut[b]:cut[b + 1]]
        if len(h):
            k = rest[head[h]]
            places = first[rest[np.repeat(head[h], times[h]) + _runs(times[h])]]
            out.append((b, tid[k].tobytes(), ids[k].tobytes(), places.tobytes(), np.stack([size[k], times[h]]).astype("<u4").tobytes(),
                        gather(body, start[k], size[k]).tobytes()))
    cols = list(zip(*out)) if out else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                      ["bucket", "tid", "ids", "first", "size", "body"])


def _bucket_spans(table: pa.Table, buckets: int) -> pa.Table:
    """(tid, spans) of one bucket's contexts, single windows among them."""
    bucket = table.column("bucket")[0].as_py()
    if buckets <= bucket < 2 * buckets:
        return pa.table({"tid": pa.array([np.frombuffer(t, np.int64)[0] for t in table.column("tid").to_pylist()], pa.int64()),
                         "spans": table.column("body").cast(pa.binary())})
    read = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()])
    tid, ids, places, body = read("tid", np.int64), read("ids", np.int64), read("first", np.int64), read("body", np.uint8)
    size, times = np.concatenate([np.frombuffer(x, "<u4").reshape(2, -1) for x in table.column("size").to_pylist()], axis=1).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    pick, which = _distinct(_equal_contexts(body, size), ids)
    low = window_minimum(gather(body, start[pick], size[pick]), size[pick], ids[pick], LEAST)
    n = size - LEAST + 1
    base = np.concatenate([[0], np.cumsum(n[pick])])[:-1]
    within = _runs(n)
    owner = np.repeat(np.arange(len(n)), n)
    gone = low[base[which][owner] + within] < ids[owner]
    fresh = within == 0
    before = np.concatenate([[False], gone[:-1]]) & ~fresh
    after = np.concatenate([gone[1:], [False]]) & ~np.concatenate([fresh[1:], [True]])
    begin, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
    # Each run of windows goes at every place of its context.
    o = owner[begin]
    many = times[o]
    place = places[np.repeat(np.concatenate([[0], np.cumsum(times)])[:-1][o], many) + _runs(many)]
    t, spans = _span_rows(np.repeat(tid[o], many), place + np.repeat(within[begin], many), place + np.repeat(within[end] + LEAST, many))
    return pa.table({"tid": pa.array(t, pa.int64()), "spans": pa.array(spans, pa.binary())})


def covered_spans(rows: DataFrame, buckets: int, spread: int) -> DataFrame:
    """(tid, spans): what to cut. ``rows`` has (tid, id, text, keys, common): a text, its smallest id and its shared anchors.

    Windows of the ``common`` ones among them (null: none) are compared one by one in ``spread`` buckets.
    """

    def emit(batches):
        held, seen = [], 0
        for batch in batches:
            for piece in V.pieces_of(batch, "text", PIECE_BYTES):
                data, off = V.column_bytes(piece.column(2))
                keys, first, last = anchors(data, off)
                doc = np.searchsorted(off, first, "right") - 1
                wanted, many = piece.column(3), piece.column(4)
                cut = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                hit, common = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
                for i in range(piece.num_rows):
                    mine = np.frombuffer(wanted[i].as_py(), np.uint64)
                    hit[cut[i]:cut[i + 1]] = np.isin(keys[cut[i]:cut[i + 1]], mine)
                    if many[i].is_valid:
                        mine = np.array(many[i].as_py(), np.int64).view(np.uint64)
                        common[cut[i]:cut[i + 1]] = np.isin(keys[cut[i]:cut[i + 1]], mine)
                at = np.flatnonzero(hit)
                if len(at) == 0:
                    continue
                size = last[at] - first[at] + LEAST
                held.append((keys[at], common[at], piece.column(0).to_numpy()[doc[at]], piece.column(1).to_numpy()[doc[at]],
                             first[at] - off[doc[at]], size, gather(data, first[at], size)))
                seen += int(size.sum())
                if seen >= FLUSH_BYTES:
                    yield _context_rows(held, buckets, spread)
                    held, seen = [], 0
        if held:
            yield _context_rows(held, buckets, spread)

    sent = rows.select("tid", "id", "text", "keys", "common").mapInArrow(
        emit, "bucket int, tid binary, ids binary, first binary, size binary, body binary")
    found = sent.groupBy("bucket").applyInArrow(lambda t: _bucket_spans(t, buckets), "tid long, spans binary")
    return found.groupBy("tid").agg(F.collect_list("spans").alias("spans"))


# --- the operator ----------------------------------------------------------------------------------------------------

def union_spans(parts) -> np.ndarray:
    """Disjoint, sorted (start, end) rows from packed span lists."""
    s = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
    if len(s) == 0:
        return s
    s = s[np.argsort(s[:, 0], kind="stable")]
    reach = np.maximum.accumulate(s[:, 1])
    new = np.ones(len(s), bool)
    new[1:] = s[1:, 0] > reach[:-1]
    begin = np.flatnonzero(new)
    return np.stack([s[begin, 0], reach[np.concatenate([begin[1:], [len(s)]]) - 1]], axis=1)


def cut_out(text: bytes, spans: np.ndarray) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _identified(docs: DataFrame, others: list[str]) -> DataFrame:
    """(id, text, md5, tid, rid, others) of every row; a null id is the largest. ``others`` are further columns, as one struct.

    ``tid`` belongs to the text, ``rid`` to the text and the id: copies of a text have one tid and different rids.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       row.alias("others"))
    rows = rows.withColumn("md5", F.md5(F.col("text").cast("binary")))
    return rows.withColumn("tid", F.conv(F.substring("md5", 1, 15), 16, 10).cast("long")).withColumn("rid", _rid("md5", "id"))


def _rid(md5: str, key: str) -> Column:
    return F.xxhash64(md5, key)


def _bucketed(rows: DataFrame) -> DataFrame:
    """The rows bucketed by ``rid`` below the shared checkpoint folder, one file per bucket.

    Rids spread copies of a text evenly, so no bucket grows with a group of copies.
    """
    spark = rows.sparkSession
    name = f"repeats_{uuid.uuid4().hex[:16]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "repeat-texts")
    rows.repartition(n, "rid").write.option("compression", "zstd").option("path", path).bucketBy(n, "rid").saveAsTable(name)
    out = spark.table(name)
    out.schema  # the frame holds the files and their buckets: the catalog's entry is not needed any more
    spark.sql(f"DROP TABLE {name}")
    return out


def _same(a: str, b: str) -> Column:
    """Equality that does not become a join key: the join stays on the bucket column alone, and the texts in their buckets."""
    return (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))


def repeated_spans(docs: DataFrame, others: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the stored rows (id, text, md5, tid, rid, others), and (rid, spans) of the texts that lose bytes.

    Only the row with a text's smallest id is looked at; the others are copies.
    """
    rows = _bucketed(_identified(docs, others))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    entries = 2 * size // (WINDOW + 1)
    keys = stored(shared_anchors(rows, max(1, -(-entries // BUCKET_ENTRIES)), MOST_CONTEXTS), "repeat-anchors")
    common = common_anchors(keys)
    spread = max(1, -(-(common.agg(F.sum("places")).first()[0] or 0) * WINDOW // BUCKET_WINDOWS))
    marked = anchor_rows(keys).join(common, "key", "left_semi").groupBy("tid").agg(F.collect_set("key").alias("common"))
    smallest = rows.groupBy("tid", "md5").agg(F.min("id").alias("low"))
    wanted = keys.filter("tid is not null").join(marked, "tid", "left").join(smallest, "tid")
    wanted = wanted.select(_rid("md5", "low").alias("__rid"), F.col("md5").alias("__md5"), "low", "keys", "common")
    held = rows.join(wanted, F.col("rid") == F.col("__rid")).filter(_same("md5", "__md5") & _same("id", "low"))
    n_keys = keys.filter("tid is not null").agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    n = max(1, -(-(n_keys // 8 * 64) // BUCKET_BYTES))
    spans = covered_spans(held.select(F.col("rid").alias("tid"), "id", "text", "keys", "common"), n, spread)
    spans = stored(spans.select(F.col("tid").alias("__rid"), "spans"), "repeat-spans")
    return rows, spans


KEPT = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.StringType())])


def _kept(as_digest: bool):
    @F.arrow_udf(KEPT)
    def kept(text: pa.Array, spans: pa.Array) -> pa.Array:
        removed, count, out = [], [], []
        for t, s in zip(text, spans):
            raw = t.as_py().encode()
            found = union_spans(s.as_py() or [])
            rest = cut_out(raw, found) if len(found) else raw
            removed.append(len(raw) - len(rest))
            count.append(len(found))
            out.append(hashlib.sha256(rest).hexdigest() if as_digest else rest.decode("utf-8", "ignore"))
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(out, pa.string())],
                                          ["n_removed", "n_spans", "kept"])

    return kept


def _with_kept(docs: DataFrame, as_digest: bool, others: list[str]) -> DataFrame:
    """(id, text, others, n_bytes, n_removed, n_spans, kept) of every row."""
    rows, spans = repeated_spans(docs, others)
    names = rows.select("id", "md5", "rid")
    low = names.groupBy("md5").agg(F.min("id").alias("low")).withColumnRenamed("md5", "__md5")
    copies = names.join(low, F.col("md5") == F.col("__md5")).filter(F.col("id") > F.col("low"))
    copies = copies.select(F.col("rid").alias("__copy"), F.col("id").alias("__id"), "__md5").distinct()
    # Both sides come to the rows' buckets; the texts stay where they are.
    both = rows.join(spans, F.col("rid") == F.col("__rid"), "left").join(
        copies, (F.col("rid") == F.col("__copy")) & _same("id", "__id") & _same("md5", "__md5"), "left")
    size = F.octet_length("text")
    copy = F.col("__copy").isNotNull() & (size >= LEAST)
    both = both.withColumn("spans", F.when(copy, F.array()).otherwise(F.col("spans")).cast("array<binary>"))
    both = both.withColumn("out", _kept(as_digest)(F.col("text"), F.col("spans")))
    empty = F.lit(hashlib.sha256(b"").hexdigest() if as_digest else "")
    return both.select(
        "id", "text", "others", size.cast("long").alias("n_bytes"), F.when(copy, size).otherwise(F.col("out.n_removed")).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.col("out.n_spans")).cast("long").alias("n_spans"), F.when(copy, empty).otherwise(F.col("out.kept")).alias("kept"))


def removed_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per input row."""
    out = _with_kept(docs, True, [])
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns, all rows) with the repeated passages cut out of ``text``.

    Bytes of a character that a cut splits go with it; a null text stays null.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = _with_kept(docs.withColumn("__null", F.col("text").isNull()), False, [*others, "__null"])
    new = {"doc_id": F.when(F.col("id") != NO_ID, F.col("id")), "text": F.when(~F.col("others")["__null"], F.col("kept"))}
    return out.select(*[new.get(c, F.col("others")[c]).alias(c) for c in docs.columns])
