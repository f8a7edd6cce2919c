"""Token ids of whole texts by a public word-level BPE file, with a bounded cache of words.

The tokenizer's normaliser and splitter never join characters across white space, so a text's ids are those of its
white-space words in order; it ignores case, and a closing punctuation mark after a letter is a piece of its own. Words
repeat a lot; the cache turns most of the work into dictionary reads. A text with one of the four separators that Python
splits on and the tokenizer doesn't is encoded as a whole.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from rillflow.llm import worker

CACHE_WORDS = 450_000  # in each of two generations, about 200 bytes a word
LONGEST_CACHED = 64
ODD = (b"\x1c", b"\x1d", b"\x1e", b"\x1f")
MARKS = frozenset(".,;:!?")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _letters(word: str) -> bool:
    """Whether it is letters alone, before and after the normaliser."""
    return word.isalpha() and (word.isascii() or (word == word.lower() and unicodedata.is_normalized("NFC", word)))


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._encode = Tokenizer.from_file(path).encode_batch_fast
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self._ends = np.zeros(1 << 16, bool)
        self._ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self._marks = dict(zip(sorted(MARKS), self._plain(sorted(MARKS)), strict=True))
        self._ids: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._encode(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Of words of letters alone: one call, cut where a word ends."""
        ids = np.array(self._encode([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
        if len(ends) != len(words):
            return self._plain(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _learn(self, distinct: set[str]) -> None:
        missing = distinct.difference(self._ids)
        if len(self._ids) + len(missing) > CACHE_WORDS:
            self._ids, self._old, missing = {}, self._ids, distinct
        ids, old, closed, letters, others = self._ids, self._old, [], [], []
        for w in missing:
            if w[-1] in MARKS and _letters(stem := w[:-1]):
                closed.append(w)
                w = stem
            if w in ids:
                continue
            if (known := old.get(w)) is not None:
                ids[w] = known
            else:
                ids[w] = b""  # asked for once
                (letters if _letters(w) else others).append(w)
        for some, encode in ((letters, self._words), (others, self._plain)):
            if some:
                ids.update(zip(some, encode(some), strict=True))
        for w in closed:
            ids[w] = ids[w[:-1]] + self._marks[w[-1]]

    def packed_all(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of UTF-8 texts, as little-endian unsigned 32-bit numbers. What they have of new words is learned at once."""
        out: list[bytes] = [b""] * len(texts)
        split, distinct = [], set()
        for i, text in enumerate(texts):
            if not text:
                continue
            words = [] if any(x in text for x in ODD) else text.lower().decode().split()  # of bytes, lower() changes A-Z only
            if not words or max(map(len, words)) > LONGEST_CACHED:
                out[i] = self._plain([text.decode()])[0]
            else:
                split.append((i, words))
                distinct.update(words)
        self._learn(distinct)
        ids = self._ids
        for i, words in split:
            out[i] = b"".join([ids[w] for w in words])
        return out

    def packed(self, text: bytes | None) -> bytes:
        return self.packed_all([text])[0]

    def counts(self, texts: list[bytes | None]) -> list[int]:
        return [len(x) >> 2 for x in self.packed_all(texts)]


TOGETHER = 1  # texts whose words are looked up at once
_made: dict[str, WordTokenizer] = {}
worker.caches("tokens", _made.clear)


def slices(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """A column's values, some at once, and where they start."""
    for at in range(0, len(column), TOGETHER):
        yield at, column.slice(at, TOGETHER).to_pylist()


def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so its cache outlives a task."""
    worker.enter("tokens")
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]
