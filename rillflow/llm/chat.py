"""Chat formatting at the level of tokens.

Each segment of text is encoded on its own, and the template's marks are reserved ids spliced between, so no text can make a
mark. Control strings that occur in a text are escaped in it as well (a backslash goes after their first character, one more if
some stand there), which can be undone and keeps the rendered text free of false marks. The loss mask comes from prefix sums
of +1 where an assistant's text starts and -1 where it ends.

Rows are dealt by conversation and span of CHUNK_TURNS turns, so one very long conversation is many tasks' work, and are written
as parts of a bounded number of tokens; the marks that open and close a conversation are parts of their own. Parts have numbers that
follow the turns. Reading back decodes parts wherever they are; only digests over a whole conversation, which are sequential by
nature, take its parts in order, as a stream. Memory is bounded by the longest turn and not by the longest conversation.

Defined cases: a null text or role is empty; roles that the template doesn't know are written by name; ties in turn are
ordered by role and text; repeated rows are turns like others; very long texts are encoded whole; a null conv_id is a conversation of
its own; a null turn comes first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.store import partitions, small_batches

#: The template's control strings in the order of their reserved ids, which follow the vocabulary's; fixed values.
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ASST]", "[/ASST]", "[ROLE]", "[/ROLE]", "[END]"]
TURNS = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("[ASST]", "[/ASST]")}
PART_TOKENS, CHUNK_TURNS = 100_000, 4096
#: Parts of a span of turns are numbered from its number times this on; spans beyond the outermost share those.
PARTS_OF_CHUNK, CHUNKS = 1 << 20, 1 << 40
OPENS, CLOSES = -(1 << 62), 1 << 62

_starts = "|".join(f"(?<={re.escape(m[0])})(\\\\*)(?={re.escape(m[1:])})" for m in MARKS)
_find = re.compile(_starts)


def escape(text: str) -> str:
    return _find.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _find.sub(lambda m: m[0][1:], text)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_made: dict[str, object] = {}


def encoding(path: str):
    if path not in _made:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _made[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _made[path]


def mark_ids(path: str) -> dict[str, int]:
    """The reserved ids: those after the vocabulary's."""
    first = encoding(path).max_token_value + 1
    return {m: first + i for i, m in enumerate(MARKS)}


def segments(role: str, text: str) -> list[tuple[str, bool]]:
    """Marks and escaped texts of a turn, and whether each is learned from."""
    if role in TURNS:
        first, last = TURNS[role]
        return [(first, False), (escape(text), role == "assistant"), (last, False)]
    return [("[ROLE]", False), (escape(role), False), ("[/ROLE]", False), (escape(text), False), ("[END]", False)]


def turn_ids(encode, marks: dict[str, int], role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and loss mask of a turn."""
    ids, learn = [], []
    for k, (s, loss) in enumerate(segments(role, text)):
        is_mark = k % 2 == 0
        ids.append([marks[s]] if is_mark else encode(s))
        learn.append(loss)
    return np.array([i for x in ids for i in x], np.int32), mask([len(x) for x in ids], learn)


def mask(lengths: list[int], learn: list[bool]) -> np.ndarray:
    """From prefix sums of where learned segments start and end."""
    ends = np.cumsum(lengths)
    change = np.zeros(int(ends[-1]) + 1, np.int8)
    for end, n, loss in zip(ends.tolist(), lengths, learn, strict=True):
        if loss and n:
            change[end - n] += 1
            change[end] -= 1
    return np.cumsum(change[:-1]).astype(bool)


PARTS = "conv_id long, part long, ids array<int>, loss array<boolean>"


def format_chats(turns: DataFrame, ranks: str | None = None) -> DataFrame:
    """conv_id, part, ids and loss (a truth value for each id)."""
    path = ranks or default_ranks()
    small_batches(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    span = F.greatest(F.lit(1 - CHUNKS), F.least(F.lit(CHUNKS), F.floor(F.col("turn") / CHUNK_TURNS)))
    rows = rows.withColumn("chunk", F.when(F.col("turn").isNull(), F.lit(-CHUNKS)).otherwise(span))
    dealt = rows.repartition(partitions(turns.sparkSession), "conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "turn", "role", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, marks = encoding(path).encode_ordinary, mark_ids(path)
        here, part, held, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            ids, loss = (np.concatenate([h[k] for h in held]) for k in range(2))
            number = here[1] * PARTS_OF_CHUNK + part
            return pa.record_batch({"conv_id": pa.array([here[0]], pa.int64()), "part": pa.array([number], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32())), "loss": pa.array([loss], pa.list_(pa.bool_()))})

        for b in batches:
            for conv, role, text, chunk in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if (conv, chunk) != here:
                    if held:
                        yield out()
                    here, part, held, size = (conv, chunk), 0, [], 0
                held.append(turn_ids(encode, marks, role, text))
                size += len(held[-1][0])
                if size >= PART_TOKENS:
                    yield out()
                    part, held, size = part + 1, [], 0
        if held:
            yield out()

    first, last = (mark_ids(path)[m] for m in ("<s>", "</s>"))
    ends = F.array(*[F.struct(F.lit(nr).alias("part"), F.array(F.lit(i)).alias("ids")) for nr, i in ((OPENS, first), (CLOSES, last))])
    marks = rows.select("conv_id").distinct().select("conv_id", F.explode(ends).alias("x"))
    return dealt.mapInArrow(task, PARTS).unionByName(marks.select("conv_id", F.col("x.part").alias("part"), F.col("x.ids").alias("ids"), F.array(F.lit(False)).alias("loss")))


class Reader:
    """Turns back from ids; feed() takes a part, which holds whole turns, and yields role, text, length of the turn as rendered, and the
    text under the loss mask (None if there is none)."""

    def __init__(self, path: str):
        self.decode, self.first = encoding(path).decode_bytes, mark_ids(path)["<s>"]

    def feed(self, ids: np.ndarray, loss: np.ndarray) -> Iterator[tuple[str | None, str, int, str | None]]:
        marks = np.flatnonzero(ids >= self.first)
        role, text, chars, learned = "", "", 0, None
        opens = {a: r for r, (a, _) in TURNS.items()}
        closes = {b for _, b in TURNS.values()} | {"[END]"}
        for i, at in enumerate(marks.tolist()):
            mark = MARKS[int(ids[at]) - self.first]
            end = int(marks[i + 1]) if i + 1 < len(marks) else len(ids)
            raw = self.decode(ids[at + 1 : end].tolist()).decode()
            chars += len(mark)
            if mark in ("<s>", "</s>"):
                yield None, "", len(mark), None
                role, text, chars, learned = "", "", 0, None
            elif mark in closes:
                yield role, text, chars, learned
                role, text, chars, learned = "", "", 0, None
            else:
                chars += len(raw)
                if mark == "[ROLE]":
                    role = unescape(raw)
                else:
                    role, text = opens.get(mark, role), unescape(raw)
                    under = ids[at + 1 : end][loss[at + 1 : end]]
                    learned = unescape(self.decode(under.tolist()).decode()) if len(under) else None


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(parts: DataFrame, ranks: str | None = None) -> DataFrame:
    """What the formatted conversations hold, read back from their ids and masks."""
    path = ranks or default_ranks()
    small_batches(parts.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(path).feed
        for b in batches:
            for k in range(b.num_rows):
                ids, learn = (b.column(i)[k].values.to_numpy(zero_copy_only=False) for i in (2, 3))
                n, chars, formatted, whole, loss = 0, 0, 0, [], []
                for role, text, size, learned in read(ids, learn):
                    formatted += size
                    if role is not None:
                        n += 1
                        whole.append(f"{role}\n{text}\n")
                        if learned is not None:
                            chars += len(learned)
                            loss.append(learned)
                texts = [pa.array(["".join(x).encode()], pa.binary()) for x in (whole, loss)]
                yield pa.record_batch([b.column(0).slice(k, 1), b.column(1).slice(k, 1), *[pa.array([x], pa.int64()) for x in (n, chars, formatted)], *texts], names=DECODED)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, sums, turns, loss, rows = None, False, [0, 0, 0], None, None, []

        def row() -> tuple:
            return conv, sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2]

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [x.split()[0] for x in DIGESTS.split(", ")]
            return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for b in batches:
            for k, c in enumerate(b.column(0).to_pylist()):
                if not begun or c != conv:
                    if begun:
                        rows.append(row())
                    conv, begun, sums, turns, loss = c, True, [0, 0, 0], hashlib.sha256(), hashlib.sha256()
                sums = [x + b.column(2 + i)[k].as_py() for i, x in enumerate(sums)]
                turns.update(b.column(5)[k].as_buffer())
                loss.update(b.column(6)[k].as_buffer())
                if len(rows) >= 1000:
                    yield out()
                    rows = []
        if begun:
            rows.append(row())
        if rows:
            yield out()

    decoded = parts.mapInArrow(decode, "conv_id long, part long, n long, chars long, formatted long, turns binary, loss binary")
    return decoded.repartition(partitions(parts.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(hashed, DIGESTS)


DECODED = ["conv_id", "part", "n", "chars", "formatted", "turns", "loss"]


def rendered(parts: DataFrame, ranks: str | None = None) -> DataFrame:
    """conv_id, part and the formatted text."""
    path = ranks or default_ranks()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode, first = encoding(path).decode_bytes, mark_ids(path)["<s>"]
        for b in batches:
            texts = []
            for k in range(b.num_rows):
                ids, out, last = b.column(2)[k].values.to_numpy(zero_copy_only=False), [], 0
                for at in [*np.flatnonzero(ids >= first).tolist(), len(ids)]:
                    out.append(decode(ids[last:at].tolist()).decode())
                    out.append(MARKS[int(ids[at]) - first] if at < len(ids) else "")
                    last = at + 1
                texts.append("".join(out))
            yield pa.record_batch({"conv_id": b.column(0), "part": b.column(1), "text": pa.array(texts, pa.string())})

    return parts.mapInArrow(task, "conv_id long, part long, text string")
