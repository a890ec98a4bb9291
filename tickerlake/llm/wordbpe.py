"""Token ids of whole texts by a ``tokenizers`` file, remembered per word.

The file's normalizer lower-cases and its pre-tokenizer cuts a text into words whose
ids do not depend on their surroundings, so a text is cut by one pattern and each
distinct word is merged once per worker. Only texts made of characters for which that
cut provably equals the file's are treated so: plain ASCII, and the letters and signs
below U+0250 that stay there when lower-cased. All other texts, and those holding one
of the file's special strings, go through the library whole.

White space belongs to no word, so a text of such characters is first split there, and
the ids of a whole run between white space are remembered too: one look-up for a word with
the signs around it, without the pattern.

Remembered words and runs are bounded in number and in length, so the memory is bounded
whatever the texts hold; a longer word is merged each time it stands.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from functools import lru_cache

import numpy as np

#: Runs and words remembered per Python worker, and the longest (characters) that is remembered.
RUNS_REMEMBERED, WORDS_REMEMBERED, LONGEST_REMEMBERED = 500_000, 250_000, 32
#: ASCII characters that the pattern cuts as the file does: white space and print, without other control characters.
PLAIN = bytes([9, 10, 13, *range(32, 127)])


def _kind(c: str) -> str:
    return unicodedata.category(c)[0]


def _plain_beyond_ascii() -> str:
    """Characters from U+00A1 below U+0250 whose lower case is one character of that range of the same kind."""
    out = []
    for code in range(0xA1, 0x250):
        c = chr(code)
        low = c.lower()
        if code != 0xAD and len(low) == 1 and ord(low) < 0x250 and _kind(low) == _kind(c) and unicodedata.normalize("NFC", c) == c:
            out.append(c)
    return "".join(out)


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Little-endian 32-bit ids per word (or run); a missing one is made by ``merge``."""

    def __init__(self, merge, most: int):
        super().__init__()
        self.merge, self.most = merge, most

    def __missing__(self, word: str) -> bytes:
        ids = self.merge(word)
        if len(word) <= LONGEST_REMEMBERED and len(self) < self.most:
            self[word] = ids
        return ids


class WordIds:
    """Little-endian 32-bit ids of a text, for the lower-casing word tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        beyond = _plain_beyond_ascii()
        self.beyond = frozenset(beyond)
        letters = "a-z" + "".join(re.escape(c) for c in beyond if _kind(c) == "L")
        numbers = "0-9" + "".join(re.escape(c) for c in beyond if _kind(c) == "N")
        # Fixed value: the file's own split pattern, with its classes spelled out for the plain range.
        self.cut = re.compile(rf"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^\s{letters}{numbers}]+").findall
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        # The byte-level alphabet of the file: what each byte of a word stands as in the vocabulary.
        step = self.lib.pre_tokenizer.pre_tokenize_str
        self.signs = {b: step(chr(b))[0][0] for b in range(0x21, 0x7F)}
        if any(s != chr(b) for b, s in self.signs.items()):
            raise ValueError("the file's alphabet changes printable ASCII")
        # The alphabet is one of bytes, so a word's signs are those of its characters.
        self.spelled = {ord(c): "".join(s for s, _ in step(c)) for c in beyond}
        self.model = self.lib.model
        self.words = Words(self._merge, WORDS_REMEMBERED)
        self.runs = Words(self._run, RUNS_REMEMBERED)

    def _merge(self, word: str) -> bytes:
        return pack_ids([t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.spelled))])

    def _run(self, run: str) -> bytes:
        """Ids of lower-case text without white space."""
        return b"".join(map(self.words.__getitem__, self.cut(run)))

    def _library(self, text: str) -> bytes:
        return np.asarray(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> bool:
        """Whether the text holds no character (or special string) that needs the library."""
        rest = text.encode().translate(None, PLAIN)
        return (not rest or self.beyond.issuperset(rest.decode())) and not any(s in text for s in self.special)

    def ids(self, text: str) -> bytes:
        if not self.plain(text):
            return self._library(text)
        return b"".join(map(self.runs.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
