"""Operator 7, token counts: byte-pair merging with a heap and a linked list, no identifiers emitted.

For a SentencePiece BPE model. A text is cut where no piece of the vocabulary can
reach across (before a run of word marks, around characters that no longer piece
holds); each cut-out unit starts as a linked list of its characters, and the
adjacent pair whose join ranks lowest is popped from a heap again and again.
A unit's count is its initial symbols minus its merges; a character unknown to the
vocabulary starts as its UTF-8 bytes. Counts of short units are remembered per task.

Defined results: a null or empty text has 0 bytes and 0 tokens; very long texts and
units are counted whole; repeated rows each get their row; an empty table gives an
empty result; only id and text are read. Special strings inside a text are
ordinary text, as is the library's default.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tickerlake.llm.common import map_arrow, texts

MARK = "▁"
#: Units remembered per Python worker, and the longest that is remembered.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 48
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Merger:
    """Merge ranks of one SentencePiece BPE model, and counting by them."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.rank, self.single = {}, set()
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            if len(piece) > 1:
                self.rank[piece] = (-sp.get_score(i), i)
            else:
                self.single.add(piece)
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("pieces reach over a word mark: units are not independent")
        inner = {c for p in self.rank for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in inner)
        self.alone = f"[{re.escape(alone)}]" if alone else ""
        stop = MARK + re.escape(alone)
        units = [rf"{MARK}*[^{stop}]+", f"{MARK}+"] + ([self.alone] if alone else [])
        self.unit = re.compile("|".join(units))
        self.longest = max(map(len, self.rank), default=1)
        self.known: dict[str, int] = {}

    def start_symbols(self, unit: str) -> int:
        """Symbols before any merge: characters, or the bytes of those that the vocabulary lacks."""
        return sum(1 if c in self.single else len(c.encode()) for c in unit)

    def count(self, unit: str) -> int:
        """Initial symbols minus merges."""
        n = len(unit)
        if n < 2:
            return self.start_symbols(unit)
        rank, longest = self.rank, self.longest
        end = list(range(1, n + 1))  # symbol at i is unit[i:end[i]]; 0 once merged away
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(unit[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:  # one of the two has changed meanwhile
                continue
            end[mid] = 0
            end[i] = stop
            merges += 1
            if stop < n:
                before[stop] = i
                if end[stop] - i <= longest:
                    r = rank.get(unit[i:end[stop]])
                    if r is not None:
                        heapq.heappush(heap, (r, i, end[stop]))
            left = before[i]
            if left >= 0 and stop - left <= longest:
                r = rank.get(unit[left:stop])
                if r is not None:
                    heapq.heappush(heap, (r, left, stop))
        return self.start_symbols(unit) - merges

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for unit in self.unit.findall(MARK + text.replace(" ", MARK)):
            n = known.get(unit)
            if n is None:
                n = self.count(unit)
                if len(unit) <= LONGEST_REMEMBERED and len(known) < REMEMBERED:
                    known[unit] = n
            total += n
        return total


@lru_cache(maxsize=2)
def merger(model: str) -> Merger:
    return Merger(model)


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; ``model`` is a file all executors have."""

    def run(batch):
        m = merger(model)
        text = batch.column(1).to_pylist()
        n = [m.tokens(t) for t in text]
        size = [len(t.encode()) for t in text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(texts(docs), run, SCHEMA)
