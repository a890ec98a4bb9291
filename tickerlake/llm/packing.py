"""Operator 1, best-fit packing with Martello-Toth dominance reduction.

Pieces differ only by length, and lengths are bounded by the sequence size, so the
packing is planned on the histogram of lengths (at most ``capacity`` counts,
whatever the corpus): how many sequences hold which lengths at which offsets.
Every piece then looks its place up by its length and its rank among equals. The
plan is bounded by the capacity alone, never by the rows.

Planning goes from the longest length down. The reduction fixes item sets that
provably dominate every other set with that item (Martello & Toth, procedure MTRP):

* nothing fits beside it: it stays alone;
* some length fills the sequence exactly: the two together;
* no two items fit beside it: it goes with the longest that fits;
* at most two items fit beside it, and the longest single that fits is no shorter
  than the best fitting pair: it goes with that single.

Each condition stays true while items are only removed, so a set is fixed as many
times as its lengths allow. The remainder is packed by best-fit decreasing.

Defined results: null or empty texts are one piece, the separator alone; repeated
rows are packed like any other; texts longer than the capacity are cut into full
pieces and a last shorter one; an empty table gives an empty result; only id and
text are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import gapless_rank, map_arrow, stored, texts
from tickerlake.llm.wordbpe import word_ids

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and the separator, cut at ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    end = np.asarray([separator], "<u4").tobytes()

    def run(batch):
        t = word_ids(tokenizer)
        cols: list[list] = [[], [], [], [], [], []]
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = t.ids(text) + end
            for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                for col, v in zip(cols, (key, n, at // 4, len(part) // 4, zlib.crc32(part), part)):
                    col.append(v)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        most = len(names) if with_ids else len(names) - 1
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)][:most], names[:most])

    return map_arrow(texts(docs), run, PIECES + (", ids binary" if with_ids else ""))


class Planner:
    """Packing of a length histogram; groups of equal sequences are kept as one entry.

    ``slots`` are (length, first rank, sequences, repeats, first sequence, offset):
    ranks first, first + 1, ... of a length go to ``sequences`` consecutive
    sequences, ``repeats`` items side by side in each.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            if not 0 < length <= capacity:
                raise ValueError(f"length {length} is not in 1..{capacity}")
            self.count[length] += n
        self.used = np.zeros(capacity + 1, np.int64)
        self.sequences = 0
        self.fixed = 0
        self.slots: list[tuple[int, int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)

    def place(self, length: int, sequences: int, repeats: int, first: int, offset: int) -> None:
        self.slots.append((length, int(self.used[length]), sequences, repeats, first, offset))
        self.used[length] += sequences * repeats
        self.count[length] -= sequences * repeats

    def fix(self, lengths: tuple[int, ...], times: int) -> None:
        offset = 0
        for x in lengths:
            self.place(x, times, 1, self.sequences, offset)
            offset += x
        self.sequences += times
        self.fixed += times * len(lengths)

    def longest(self, room: int) -> int:
        """Longest remaining length that fits into ``room``; 0 if none."""
        have = np.flatnonzero(self.count[:room + 1])
        return int(have[-1]) if len(have) else 0

    def best_pair(self, room: int) -> int:
        """Largest sum of two remaining items that fits into ``room``; 0 if no two fit."""
        have = np.flatnonzero(self.count[:room + 1])
        best, lo, hi = 0, 0, len(have) - 1
        while lo <= hi:
            a, b = int(have[lo]), int(have[hi])
            if a + b > room or (lo == hi and self.count[a] < 2):
                hi -= 1
            else:
                best = max(best, a + b)
                lo += 1
        return best

    def smallest_sum(self, n: int) -> int:
        """Sum of the n shortest remaining items; more than the capacity if there are fewer."""
        total = 0
        for x in np.flatnonzero(self.count):
            take = min(n, int(self.count[x]))
            total += take * int(x)
            n -= take
            if n == 0:
                return total
        return self.capacity + 1

    def reduce(self) -> None:
        for x in range(self.capacity, 0, -1):
            while self.count[x] > 0:
                room = self.capacity - x
                self.count[x] -= 1  # the item itself is not one of its companions
                mate = self.longest(room)
                two = self.smallest_sum(2) <= room
                three = two and self.smallest_sum(3) <= room
                pair = self.best_pair(room) if two and not three and mate and mate != room else 0
                self.count[x] += 1
                if mate == 0:
                    self.fix((x,), int(self.count[x]) if x * 2 > self.capacity else 1)
                elif mate == room or not two or (not three and mate >= pair > 0):
                    times = int(self.count[x]) // 2 if mate == x else int(min(self.count[x], self.count[mate]))
                    self.fix((x, mate), times)
                else:
                    break

    def best_fit(self) -> None:
        rooms = np.zeros(self.capacity + 1, np.int64)  # open sequences by room

        def push(room: int, first: int, n: int) -> None:
            if n and room:
                self.open[room].append((first, n))
                rooms[room] += n

        for x in range(self.capacity, 0, -1):
            while self.count[x] > 0:
                fits = np.flatnonzero(rooms[x:])
                n = int(self.count[x])
                if len(fits):
                    room = x + int(fits[0])
                    first, have = self.open[room].pop()
                    rooms[room] -= have
                else:
                    room, first = self.capacity, self.sequences
                    have = -(-n // (room // x))
                    self.sequences += have
                each = min(room // x, n)
                full = min(have, n // each)
                self.place(x, full, each, first, self.capacity - room)
                push(room - each * x, first, full)
                rest = have - full
                left = int(self.count[x])
                if rest and 0 < left < each:
                    self.place(x, 1, left, first + full, self.capacity - room)
                    push(room - left * x, first + full, 1)
                    push(room, first + full + 1, rest - 1)
                else:
                    push(room, first + full, rest)

    def plan(self) -> np.ndarray:
        """Slots ordered by (length, first rank), as a table of 64-bit integers."""
        self.reduce()
        self.best_fit()
        table = np.array(self.slots, np.int64).reshape(-1, 6)
        return table[np.lexsort((table[:, 1], table[:, 0]))]


def look_up(plan: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the piece with that rank among its length's pieces."""
    # Ranks of one length are contiguous from 0: one search over (length, first rank).
    at = np.zeros(len(length), np.int64)
    base = np.searchsorted(plan[:, 0], length, "left")
    stop = np.searchsorted(plan[:, 0], length, "right")
    lo, hi = base, stop
    while np.any(hi - lo > 1):
        mid = (lo + hi) // 2
        right = (hi - lo > 1) & (plan[np.minimum(mid, len(plan) - 1), 1] <= rank)
        left = (hi - lo > 1) & ~right
        lo, hi = np.where(right, mid, lo), np.where(left, mid, hi)
    at = lo
    slot = plan[at]
    into = rank - slot[:, 1]
    return slot[:, 4] + into % slot[:, 2], slot[:, 5] + (into // slot[:, 2]) * slot[:, 0]


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (stored; with a column ``length``) with sequence_id and offset.

    One aggregate brings the histogram (at most ``capacity`` rows) to the driver.
    """
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Planner(counts, capacity).plan()
    order = [c for c in pieces.columns if c != "length"]
    ranked = gapless_rank(pieces, ["length"], order, "__rank", rows=sum(counts.values()))
    names = [f.name for f in pieces.schema.fields]

    def run(batch):
        length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
        seq, offset = look_up(plan, length, batch.column(len(names)).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                                         [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_arrow(ranked.select(*names, "__rank"), run, schema + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(stored(tokenized_pieces(docs, tokenizer, capacity), "pieces"), capacity)
