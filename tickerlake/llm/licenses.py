"""Operator 8, license scans: fuzzy search for short notices.

A notice of L characters that may hold k edits is split into k + 1 pieces: by the
pigeonhole principle at least one piece stands unchanged in every match. Exact
search for the pieces locates candidates; around each, the regex library's
bounded-error matching ``{e<=k}`` verifies the notice and gives its span: the best
match of a place, then the best ones before and behind it. The base phrases are also
found as exact consecutive words.

Texts are compared as lower-case (A to Z) words joined by single blanks.

Defined results: a null or empty text has no words, no labels and score 0; very
long texts are searched whole; repeated rows each get their row; overlapping places
all count in ``n_base``; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from tickerlake.llm.common import map_arrow, texts

#: Phrases whose exact word sequences are the base places, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices searched with errors, and the label each adds.
NOTICES = {
    "licensed under the apache license": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "gnu general public license": "gpl",
    "this work is licensed under the gnu": "gpl",
    "mozilla public license": "mpl",
    "all rights reserved": "reserved",
    "licensed under the": "license-notice",
}
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 10
#: Characters of a merged candidate window that one search covers, about.
PIECE = 400
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<label:string,first_word:long,last_word:long,edits:int>>")


class Scanner:
    """Exact seeds and bounded-error patterns of a set of notices."""

    def __init__(self, notices: dict[str, str], base: dict[str, str]):
        import regex

        self.base = [(f" {p} ", len(p.split()), label) for p, label in base.items()]
        self.notices = []
        for text, label in notices.items():
            k = max(1, len(text) // CHARS_PER_EDIT)
            cut = [round(i * len(text) / (k + 1)) for i in range(k + 2)]
            seeds = [(text[a:b], a) for a, b in zip(cut, cut[1:])]
            # Whole words only: the match begins and ends at a blank.
            pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(text)}){{e<={k}}}(?= )")
            self.notices.append((text, label, k, seeds, pattern))

    def candidates(self, body: str, size: int, k: int, seeds) -> list[tuple[int, int]]:
        """Merged windows of ``body`` in which a match must lie, from the places of the exact seeds."""
        found = []
        for seed, offset in seeds:
            at = body.find(seed)
            while at >= 0:
                found.append((max(0, at - offset - k - 1), min(len(body), at - offset + size + k + 1)))
                at = body.find(seed, at + 1)
        found.sort()
        merged: list[tuple[int, int]] = []
        for a, b in found:
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    def verified(self, body: str, a: int, b: int, least: int, most: int, pattern) -> list:
        """Matches in ``body[a:b]``: the best one of each piece, and those of the parts before and behind it.

        A piece is at most ``PIECE`` characters and a match, so each search reads a bounded text; a match is taken by the
        piece that its start lies in, and the next piece begins where the last match taken ends.
        """
        out, done = [], a
        while done < b:
            edge = min(b, done + PIECE)
            open_, found = [(done, min(b, edge + most + 1))], []
            while open_:
                x, y = open_.pop()
                m = pattern.search(body, x, y) if y - x > least else None
                if m:
                    found.append(m)
                    open_ += [(x, m.start()), (m.end(), y)]
            taken = sorted((m for m in found if m.start() < edge or edge == b), key=lambda m: m.start())
            out += taken
            done = max(edge, taken[-1].end()) if taken else edge
        return out

    def fuzzy(self, body: str) -> list[tuple[str, int, int, int, float]]:
        """(label, first char, last char, edits, closeness) of every verified notice."""
        out = []
        for text, label, k, seeds, pattern in self.notices:
            for a, b in self.candidates(body, len(text), k, seeds):
                for m in self.verified(body, a, b, len(text) - k, len(text) + k, pattern):
                    edits = sum(m.fuzzy_counts)
                    out.append((label, m.start(), m.end(), edits, 1 - edits / len(text)))
        return out

    def exact(self, body: str) -> list[tuple[int, str]]:
        """(char, label) of every place where a base phrase's words stand consecutively."""
        out = []
        for phrase, _, label in self.base:
            at = body.find(phrase)
            while at >= 0:
                out.append((at + 1, label))
                at = body.find(phrase, at + 1)
        return out

    def scan(self, text: str) -> tuple:
        words = WORD.findall(text.translate(LOWER))
        body = f" {' '.join(words)} "
        exact = self.exact(body)
        fuzzy = self.fuzzy(body)
        # Word numbers of characters, from one pass over the words' starts.
        starts = list(accumulate((len(w) + 1 for w in words), initial=1))
        word_at = lambda char: bisect_right(starts, char) - 1
        places = [word_at(at) for at, _ in exact]
        base = {label for _, label in exact}
        spans = [{"label": label, "first_word": word_at(a), "last_word": word_at(max(a, b - 1)), "edits": e}
                 for label, a, b, e, _ in fuzzy]
        score = 1.0 if exact else max((c for *_, c in fuzzy), default=0.0)
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | {s["label"] for s in spans})), score, spans)


@lru_cache(maxsize=2)
def scanner() -> Scanner:
    return Scanner(NOTICES, BASE)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: exact base places, labels, a score and the verified spans."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
             pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]))]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batch):
        s = scanner()
        rows = [s.scan(t) for t in batch.column(1).to_pylist()]
        cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *cols], ["doc_id", *names])

    return map_arrow(texts(docs), run, SCHEMA)
