"""Benchmark decontamination by CGK embedding, bit sampling and exact edit verification.

Texts are sequences of words (case-folded runs of word characters; in scripts without spaces each character is one), so case, spacing
and punctuation don't hide a passage. A document leaks an item of m words if some stretch of it is within ``max_edits`` * m word
edits of the item, or equal to it where m is under ``FREE_WORDS``: a few short words in nearly the same order may be chance.

Items of about one size form a class. For each class, windows of the item's size are looked at in every document:

* An exact bound passes most windows over: of an item cut into one part more than the allowed edits, one part is left whole. The parts'
  first words are looked up in the text, and windows start where one of them says that an item would, give or take the edits.
* The Chakraborty-Goldenberg-Koucky random walk embeds those: step by step the current word is put out and a random bit of
  (step, word) says whether to go on to the next word, so close sequences fall into step and agree in most places. The words at
  some random places of the output are the key; windows with the key of an item are candidates. A key takes places until chance would
  give a window at most FALSE of the class's items, going by how often items have those words, so frequent words make longer keys
  and not more candidates. Rounds with other bits and places follow until the recall that is measured on edited copies of the items
  reaches ``target_recall``. Where MOST_ROUNDS don't suffice, or items are so long that walks cost more than verifying, the windows of
  the first step are candidates themselves, which loses nothing.
* Each candidate is verified once, a round's before the next: Myers' bit-vector search gives the exact least edit distance of the item
  to any stretch there.

Documents stay where they are; only the benchmark travels, in blocks of at most about ``block_items`` items and ``block_chars``
characters and one pass each, so what is broadcast is bounded. Skew in documents doesn't matter, as no rows are shuffled.

Defined cases: null or empty texts and items match nothing; items of under ``min_words`` words must be equal to a stretch, and are left
out if they have under ``MIN_CHARS`` characters, as they can't be told from chance; very long texts are searched whole; equal items are
all reported; repeated rows each report; a null doc_id or item_id is reported as null; empty tables give no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm import worker
from rillflow.llm.joins import without
from rillflow.llm.store import small_batches, table

SCHEMA = "doc_id long, item_id long, edits long, item_words long, last_word long"
ARROW = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])
PLACES, MOST_ROUNDS, TRIALS, FREE_WORDS, MIN_CHARS, SEED_WORDS, LONG_WORDS, FALSE = 8, 64, 400, 10, 16, 4, 300, 1 / 64
BATCH_WORDS, AT_ONCE = 1_000_000, 1 << 20
#: Scripts that are written without spaces: Thai to Khmer, kana, and Han; fixed values.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_words = re.compile(r"\w+").findall
_unspaced = re.compile(f"[{UNSPACED}]")
_mixed = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+").findall
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.casefold()
    return _words(text) if text.isascii() or not _unspaced.search(text) else _mixed(text)


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The distinct whole numbers of the ranges [low, high)."""
    low, high = low[order := np.argsort(low)], high[order]
    reach = np.maximum.accumulate(high)
    low = np.maximum(low, np.concatenate([low[:1], reach[:-1]]))
    n = np.maximum(high - low, 0)
    return np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def allowed_edits(m: int, max_edits: float) -> int:
    return int(max_edits * m) if m >= FREE_WORDS else 0


def least_edits(masks: dict[int, int], m: int, text: list[int]) -> tuple[int, int]:
    """The least edit distance of a pattern to any stretch of the text, and the place after the first such stretch.

    masks: for each symbol, a bit for each of its places in the pattern of m symbols.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, at = full, 0, m, m, 0
    for j, symbol in enumerate(text, 1):
        eq = masks.get(symbol, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        score += (up & high != 0) - (down & high != 0)
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if score < best:
            best, at = score, j
    return best, at


#: Items, where they would start, and where the documents start in which they would.
Hits = tuple[np.ndarray, np.ndarray, np.ndarray]


class SizeClass:
    """Items of about one size, ready to be found."""

    def __init__(self, items: list[tuple[list[int | None], list[int]]], symbols: int, max_edits: float, target: float):
        """Items are the ids of a text and its words, as numbers under ``symbols``, which stands for all other words."""
        self.items, self.symbols, self.max_edits = items, symbols, max_edits
        sizes = [len(x) for _, x in items]
        self.width, self.longest = min(sizes), max(sizes)
        self.allowed = allowed_edits(self.longest, max_edits)
        self.masks: list[dict[int, int]] = []
        times = np.zeros(symbols + 2)
        for _, x in items:
            masks: dict[int, int] = defaultdict(int)
            for place, symbol in enumerate(x):
                masks[symbol] |= 1 << place
            self.masks.append(dict(masks))
            np.add.at(times, x, 1)
        #: How unlikely a word is in these items, in nats; words of no item end a key.
        self.rare = -np.log(np.maximum(times, 1e-9) / times.sum())
        self.enough = math.log(len(items) / FALSE)
        self.rounds: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.recall, self.walks = 1.0, self.allowed > 0 and self.longest <= LONG_WORDS
        if self.walks:
            self._calibrate(target)

    def seeds(self) -> Iterator[tuple[int, tuple[int, ...], int, int]]:
        """Item, first words of a part, and where the part starts in it."""
        for i, (_, x) in enumerate(self.items):
            parts = allowed_edits(len(x), self.max_edits) + 1
            q = min(SEED_WORDS, len(x) // parts)
            for k in range(parts):
                at = k * len(x) // parts
                yield i, tuple(x[at : at + q]), at

    def _walk(self, flat: np.ndarray, starts: np.ndarray, times: np.ndarray, adds: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Keys. ``places`` are steps in the order in which a key takes them."""
        at, rank, got = starts.copy(), {int(p): i for i, p in enumerate(places)}, np.empty((len(places), len(starts)), flat.dtype)
        for step in range(int(places.max()) + 1):
            symbol = flat[at]
            if step in rank:
                got[rank[step]] = symbol
            at = at + ((symbol * times[step] + adds[step] >> 17) & 1)
        key, known, open_ = np.zeros(len(starts), np.uint64), np.zeros(len(starts)), np.ones(len(starts), bool)
        for symbol in got:
            mixed = (key ^ key >> np.uint64(29)) * _ODD + symbol.astype(np.uint64) + np.uint64(1)
            key = np.where(open_, mixed, key)
            known += np.where(open_, self.rare[symbol], 0)
            open_ &= known < self.enough
        return key

    def _round(self, number: int) -> None:
        rng = np.random.default_rng([number, self.width, self.symbols])
        steps = max(PLACES, int(1.6 * self.width))
        times, adds = rng.integers(1, 1 << 31, steps) | 1, rng.integers(0, 1 << 40, steps)
        places = rng.choice(steps, PLACES, replace=False)
        flat = np.full((len(self.items), self.longest + steps + 1), self.symbols + 1, np.int64)
        for row, (_, x) in zip(flat, self.items, strict=True):
            row[: len(x)] = x
        keys = self._walk(flat.ravel(), np.arange(len(self.items)) * flat.shape[1], times, adds, places)
        order = np.argsort(keys, kind="stable")
        self.rounds.append((times, adds, places, keys[order], order))

    def _edited(self, rng: random.Random) -> tuple[int, list[int]]:
        which = rng.randrange(len(self.items))
        x = list(self.items[which][1])
        for _ in range(allowed_edits(len(x), self.max_edits)):
            place, kind = rng.randrange(len(x)), rng.randrange(3)
            if kind == 0:
                x[place] = self.symbols
            elif kind == 1 and len(x) > 1:
                del x[place]
            else:
                x.insert(place, self.symbols)
        return which, x

    def _calibrate(self, target: float) -> None:
        """Rounds until edited copies of the items, in a text of strange words, are found. Windows are those that seeds leave."""
        rng = random.Random(self.width)
        trials, gap = [self._edited(rng) for _ in range(max(100, min(TRIALS, TRIALS * 60 // self.longest)))], 2 * self.longest + 2
        flat, firsts = [], []
        for _, x in trials:
            flat += [self.symbols] * gap
            firsts.append(len(flat))
            flat += x
        flat = np.array(flat + [self.symbols] * 4 * gap, np.int64)
        seeds = Seeds([self], self.symbols)
        starts = self.windows(seeds.hits(flat, np.zeros(1, np.int64))[0])
        of, found = np.searchsorted(np.array(firsts) - gap // 2, starts, "right") - 1, np.zeros(len(trials), bool)
        wanted = np.array([w for w, _ in trials])
        for number in range(MOST_ROUNDS):
            self._round(number)
            hit, item = self._matches(flat, starts, self.rounds[-1])
            found[of[hit[item == wanted[of[hit]]]]] = True
            self.recall = float(found.mean())
            if self.recall >= target and number >= 3:
                return
        self.walks, self.rounds, self.recall = False, [], 1.0

    def windows(self, hits: Hits) -> np.ndarray:
        """Where windows start, from where items would, and not before their document."""
        _, start, first = hits
        return ranges(np.maximum(start - self.allowed, first), start + self.allowed + 1)

    def _matches(self, flat: np.ndarray, starts: np.ndarray, of: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Index of start, index of item."""
        times, adds, places, keys, order = of
        mine = self._walk(flat, starts, times, adds, places)
        low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
        many = high - low
        hit = np.repeat(np.arange(len(starts)), many)
        return hit, order[np.repeat(low, many) + np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)]

    def candidates(self, flat: np.ndarray, hits: Hits) -> Iterator[np.ndarray]:
        """Pairs (item << 40 | start), each once, some at a time."""
        if not len(hits[0]):
            return
        if not self.walks:
            yield np.unique(hits[0] << 40 | np.maximum(hits[1], hits[2]))
            return
        starts, known = self.windows(hits), np.empty(0, np.int64)
        starts = starts[starts < len(flat) - 2 * self.longest - PLACES]
        for r in self.rounds:
            for first in range(0, len(starts), AT_ONCE):
                some = starts[first : first + AT_ONCE]
                hit, item = self._matches(flat, some, r)
                new = np.setdiff1d(item << 40 | some[hit], known)
                known = np.union1d(known, new)
                yield new


class Seeds:
    """First words of the items' parts, by their number of words."""

    def __init__(self, classes: list[SizeClass], strange: int):
        self.strange, self.n = strange, len(classes)
        rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        for c, one in enumerate(classes):
            for item, some, at in one.seeds():
                rows[len(some)].append((int(self._hash(np.array(some, np.int64), len(some))[0]), c, item, at))
        self.tables = {}
        for q, some in rows.items():
            some.sort()
            self.tables[q] = (np.array([x[0] for x in some], np.uint64), *(np.array([x[k] for x in some], np.int64) for k in (1, 2, 3)))

    @staticmethod
    def _hash(flat: np.ndarray, q: int, at: np.ndarray | None = None) -> np.ndarray:
        at = np.arange(len(flat) - q + 1) if at is None else at
        out = np.full(len(at), q, np.uint64)
        for k in range(q):
            out = (out ^ out >> np.uint64(31)) * _ODD + flat[at + k].astype(np.uint64)
        return out

    def hits(self, flat: np.ndarray, firsts: np.ndarray) -> list[Hits]:
        """For each class, what parts of its items that are in the text tell. ``firsts`` are the documents' starts."""
        known, parts = flat < self.strange, []
        for q, (keys, of, item, offset) in self.tables.items():
            all_ = known[: len(flat) - q + 1].copy()
            for k in range(1, q):
                all_ &= known[k : len(flat) - q + 1 + k]
            at = np.flatnonzero(all_)
            mine = self._hash(flat, q, at)
            low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
            n = high - low
            row = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(at, n)
            parts.append((of[row], item[row], at - offset[row], firsts[np.searchsorted(firsts, at, "right") - 1]))
        if not parts:
            return []
        of, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        return [tuple(x[of == c] for x in rest) for c in range(self.n)]


class Index:
    """Found and calibrated once, on the driver; tasks get it by broadcast."""

    def __init__(self, items: list[tuple[int | None, str | None]], max_edits: float, min_words: int, target: float):
        self.symbol: dict[str, int] = {}
        ids: dict[tuple[int, ...], list[int | None]] = defaultdict(list)  # equal texts are searched once
        for item_id, text in items:
            w = words(text)
            if len(w) >= min_words or sum(map(len, w)) >= MIN_CHARS:
                ids[tuple(self.symbol.setdefault(x, len(self.symbol)) for x in w)].append(item_id)
        coded = sorted(((some, list(x)) for x, some in ids.items()), key=lambda x: len(x[1]))
        self.strange, groups = len(self.symbol), []
        for x in coded:
            first = len(groups[-1][0][1]) if groups else 0
            if groups and len(x[1]) <= 1.15 * first and (first >= FREE_WORDS or len(x[1]) == first):
                groups[-1].append(x)
            else:
                groups.append([x])
        self.classes = [SizeClass(g, self.strange, max_edits, target) for g in groups]
        self.seeds = Seeds(self.classes, self.strange)
        self.gap = max((c.allowed for c in self.classes), default=0) + 1
        self.tail = 4 * max((c.longest for c in self.classes), default=0) + 16
        self.verified = 0

    def leaks(self, docs: list[tuple[int | None, list[int]]]) -> Iterator[tuple[int | None, int | None, int, int, int]]:
        flat: list[int] = []
        firsts, ends = [], []
        for _, x in docs:
            firsts.append(len(flat))
            flat += x
            ends.append(len(flat))
            flat += [self.strange] * self.gap
        whole = np.array(flat + [self.strange] * self.tail, np.int64)
        found: dict[tuple[int, int, int], tuple[int, int, int]] = {}
        starts = np.array(firsts or [0], np.int64)
        for number, (c, hits) in enumerate(zip(self.classes, self.seeds.hits(whole, starts), strict=False)):
            done: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            for some in c.candidates(whole, hits):
                for i, start in zip((some >> 40).tolist(), (some & (1 << 40) - 1).tolist(), strict=True):
                    size = len(c.items[i][1])
                    allowed = allowed_edits(size, c.max_edits)
                    doc = bisect_right(firsts, start) - 1
                    # a stretch looked at for this item may hold this one's
                    best = found.get((doc, number, i), (size + 1,))[0]
                    if not best or any(a <= start and start + size <= b for a, b in done[doc, i]):
                        continue
                    lo, hi = max(firsts[doc], start - allowed), min(ends[doc], start + 2 * size + allowed)
                    done[doc, i].append((lo + allowed if lo > firsts[doc] else lo, hi - allowed if hi < ends[doc] else hi + size))
                    self.verified += 1
                    edits, at = least_edits(c.masks[i], size, flat[lo:hi])
                    if edits <= allowed and edits < best:
                        found[doc, number, i] = (edits, size, lo - firsts[doc] + at - 1)
        for (doc, number, i), (edits, size, last) in sorted(found.items()):
            for item_id in self.classes[number].items[i][0]:
                yield docs[doc][0], item_id, edits, size, last


RECALL = "items long, words long, most_words long, rounds long, recall double"


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")


def leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, min_words: int = 5, target_recall: float = 0.99, block_items: int = 20_000, block_chars: int = 64_000_000) -> DataFrame:
    """doc_id, item_id, edits, item_words and last_word (of the best stretch), a row for each document and item it leaks."""
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return reduce(DataFrame.unionByName, [_search(source, Index(some, max_edits, min_words, target_recall)) for some in _blocks(benchmark, block_items, block_chars)])


def recalls(benchmark: DataFrame, max_edits: float = 0.2, min_words: int = 5, target_recall: float = 0.99, block_items: int = 20_000, block_chars: int = 64_000_000) -> DataFrame:
    """A row for each size class of each block: its items and their words, the rounds, and the recall measured on edited copies. No
    rounds: all windows that the exact bound leaves are verified."""
    rows = []
    for some in _blocks(benchmark, block_items, block_chars):
        rows += [(len(c.items), c.width, c.longest, len(c.rounds), c.recall) for c in Index(some, max_edits, min_words, target_recall).classes]
    return benchmark.sparkSession.createDataFrame(rows, RECALL)


def _blocks(benchmark: DataFrame, block_items: int, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    items = _items(benchmark)
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // block_chars))
    if blocks > 1:  # rows are dealt by number, so that repeated rows spread
        items = table(items.withColumn("nr", F.monotonically_increasing_id()), "items")
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("nr"), F.lit(blocks)) == b) if blocks > 1 else items
        yield [(r.item_id, r.text) for r in mine.collect()]


def _search(source: DataFrame, index: Index) -> DataFrame:
    small_batches(source.sparkSession)
    sent = source.sparkSession.sparkContext.broadcast(index)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("leaks")
        index, held, size = sent.value, [], 0
        known, strange = index.symbol.get, index.strange

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*index.leaks(held), strict=True)] or [pa.array([], pa.int64())] * 5, schema=ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((doc_id, [known(w, strange) for w in words(text.as_py())]))
                size += len(held[-1][1])
                if size >= BATCH_WORDS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return source.mapInArrow(task, SCHEMA)


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that leak nothing."""
    return without(docs, found)
