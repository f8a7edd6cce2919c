"""Packing documents into sequences of at most 2048 tokens.

First-fit decreasing with a tournament tree of the bins' free room, run independently in randomised groups of documents.
Documents stay in the tasks that read them: a task deals its rows at random, by a seed of its own, to OPEN groups, and packs a group
when it has ``group_tokens`` or ``group_docs``. What is left at the end is one group more. So nothing is shuffled, no key can be hot,
memory is bounded whatever a partition holds, and a task that runs again deals alike, as it reads its rows in the same order.

Defined cases: a null or empty text is the end id alone; a very long text is cut into whole sequences and a rest; a null ``doc_id``
and repeated rows are packed like any other row; ties in length keep the group's order; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rillflow.llm.store import small_batches
from rillflow.llm.tokens import default_tokenizer, slices, word_tokenizer

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])
END = (1).to_bytes(4, "little")
OPEN = 4


class Tournament:
    """The free room of bins 0..n-1 as leaves of a tree in which each inner node has the larger of its two."""

    def __init__(self, n: int, room: int):
        self.size = 1 << max(0, n - 1).bit_length()
        self.most = [room] * (2 * self.size)

    def first(self, need: int) -> int:
        """The first bin with so much room; there always is one, as there are as many bins as items."""
        at, most, size = 1, self.most, self.size
        while at < size:
            at *= 2
            if most[at] < need:
                at += 1
        return at - size

    def take(self, bin_: int, amount: int) -> None:
        at, most = bin_ + self.size, self.most
        most[at] -= amount
        while at > 1:
            at >>= 1
            new = max(most[2 * at], most[2 * at + 1])
            if most[at] == new:
                break
            most[at] = new


def first_fit_decreasing(sizes: list[int], room: int) -> list[int]:
    """The bin of each item; every size is at most ``room``."""
    tree, where = Tournament(len(sizes), room), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        where[i] = tree.first(sizes[i])
        tree.take(where[i], sizes[i])
    return where


def plan(lengths: list[int], room: int, least_cut: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths (at least 1).

    Whole sequences are cut off long documents; the rests go first-fit decreasing. Then the emptiest bins are emptied into
    the room that others have left: a document is cut there, but never to fill less than ``least_cut`` tokens.
    """
    out, sequence, rests = [], 0, []
    for d, n in enumerate(lengths):
        whole = n // room
        for k in range(whole):
            out.append((d, k * room, room, sequence, 0))
            sequence += 1
        if n % room:
            rests.append((d, whole * room, n % room))
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for item, b in zip(rests, first_fit_decreasing([x[2] for x in rests], room), strict=True):
        bins.setdefault(b, []).append(item)
    filled = sorted(bins.values(), key=lambda b: sum(x[2] for x in b))
    free = [room - sum(x[2] for x in b) for b in filled]
    low, high = 0, len(filled) - 1
    others = sum(free[1:])  # of the bins after low, up to high
    while low < high:
        while low < high and free[high] < least_cut:
            others -= free[high]
            high -= 1
        if low >= high or others < room - free[low]:
            break
        give = filled[low]
        while give:
            while free[high] < least_cut and high > low:
                others -= free[high]
                high -= 1
            if high <= low:
                break
            d, start, n = give.pop()
            part = min(n, free[high])
            filled[high].append((d, start, part))
            free[high] -= part
            others -= part
            free[low] += part
            if n > part:
                give.append((d, start + part, n - part))
        if not give:
            low += 1
            others -= free[low] if low <= high else 0
    for b in filled:
        if b:
            offset = 0
            for d, start, n in b:
                out.append((d, start, n, sequence, offset))
                offset += n
            sequence += 1
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, room: int = 2048, group_tokens: int = 1_000_000, group_docs: int = 50_000, least_cut: int = 64, seed: int = 0) -> DataFrame:
    """A row per piece; ``ids_crc32`` is that of its ids as little-endian unsigned 32-bit numbers."""
    small_batches(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()

    def rows(group: list[tuple[int | None, bytes]], sequence: int) -> pa.RecordBatch:
        lengths = [len(x) >> 2 for _, x in group]
        cols: list[list[int | None]] = [[] for _ in ARROW]
        for d, start, length, seq, offset in plan(lengths, room, least_cut):
            doc_id, ids = group[d]
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            for c, v in zip(cols, (doc_id, start, length, crc, lengths[d], sequence + seq, offset), strict=True):
                c.append(v)
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols], schema=ARROW)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = word_tokenizer(tokenizer).packed_all, TaskContext.get().partitionId()
        deal, sequence = random.Random(f"{seed} {part}"), part << 40
        groups: list[list[tuple[int | None, bytes]]] = [[] for _ in range(OPEN)]
        held = [0] * OPEN
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, texts in slices(batch.column(1)):
                for doc_id, ids in zip(doc_ids[at:], encode(texts), strict=False):
                    g = deal.randrange(OPEN)
                    groups[g].append((doc_id, ids + END))
                    held[g] += (len(ids) >> 2) + 1
                    if held[g] >= group_tokens or len(groups[g]) >= group_docs:
                        yield rows(groups[g], sequence)
                        sequence, groups[g], held[g] = sequence + len(groups[g]) + held[g] // room + 1, [], 0
        rest = [x for group in groups for x in group]
        if rest:
            yield rows(rest, sequence)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(cast(text as string) as binary) text").mapInArrow(task, SCHEMA)
