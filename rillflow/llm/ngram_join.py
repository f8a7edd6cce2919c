"""Exact n-gram Jaccard join and its components.

The join is a sparse matrix product: the incidence matrix of documents by distinct n-grams times its transpose holds the
overlap of each pair. It is computed in blocks that hold every pair that can pass:

1. Documents with equal sets are one class; a class stands for its rows from here on.
2. The size bound: two sets with ``100 * overlap >= percent * union`` differ in at most ``(100 - percent) / (100 + percent)``
   of the sum of their sizes. For a range of sizes that is a number d; cutting the space of n-gram hashes into d + 1 parts,
   at least one part is equal in both sets. A set's key of each part therefore meets that of every partner, and sets that
   share only a common passage or some frequent n-grams don't meet.
   Below RARE_BELOW percent parts are of a few n-grams only, which common passages fill. There, a set's keys are the rarest of its
   n-grams: of two sets that link, each lacks at most ``n - ceil(n * percent / 100)`` of its own n in the other, so with all n-grams in
   one order, one n-gram at least is among the first ``n - ceil(n * percent / 100) + 1`` of both. The order is by the number of sets
   that have an n-gram, counted over the whole table, so n-grams of common passages come last and those of one set need no key.
3. Sets that meet form families (components over a link from each set to the least of its key). The overlaps of a family are
   accumulated for a block of rows at a time, entry by entry for n-grams that few of its sets have and as dense column blocks for the
   others; pairs below the size-derived bound are discarded.
4. A family is first held against a few leaders; what links with one is joined at once. Then only rows and blocks whose
   documents aren't joined yet are multiplied. No pair is lost: two sets in one component need no check.
5. Joins on a class, a family, a component or a key are split: hot keys meet by broadcast, so no task gets a group's rows.

Word and n-gram hashes have 64 bits, class hashes 128.

Defined cases: without words (or with null text) the set is empty, linked with nothing, and the row is its own component;
repeated rows come out repeated, and rows of one doc_id with different texts each have their own text's component; a null
doc_id is never a component's least id unless all are null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm import worker
from rillflow.llm.components import components
from rillflow.llm.joins import joined
from rillflow.llm.store import Held, drop, free, partitions, small_batches, stored, table

WORDS_CACHED = 100_000
BLOCK_DOCS, BLOCK_GRAMS, COLUMNS, TILE, LEADERS = 4096, 4_000_000, 2048, 128, 64
SPARSE, FEW_ROWS, PAIRS = 64, 4, 500_000
RARE_BELOW, SLICE_DOCS, SLICE_GRAMS, BUCKET_GRAMS, WORD_CHARS = 90, 1 << 16, 1_000_000, 1_000_000, 6
_LOW = np.uint64(0xFFFF)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORDS_CACHED:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
        return out


_hashes = _Hashes()
worker.caches("grams", _hashes.clear)


def gram_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of the words; a shorter text is one gram."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    a = np.frombuffer(b"".join([_hashes[w] for w in words]), "<u8")
    width = min(n, len(words))
    out = np.full(len(a) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * _ODD[k % 3] + a[k : len(a) - width + 1 + k]
    return np.unique(out)


def class_hash(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams, digest_size=16).digest()


@lru_cache
def size_classes(percent: int) -> list[int]:
    """Starts of ranges of sizes, so wide that sets that link lie in one range or in adjoining ones."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, (starts[-1] * 130) // 100, (starts[-1] - 1) * 100 // percent + 1))
    return starts


@lru_cache(maxsize=4096)
def _cuts(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def part_keys(grams: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set, of which it shares one at least with every other set that it links with."""
    n, starts = len(grams), size_classes(percent)
    if not n:
        return np.empty(0, np.int64)
    mixed = (grams ^ (grams >> np.uint64(31))) * _ODD[3]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed ^ (mixed >> np.uint64(30)), dtype=np.uint64)])
    own, out = bisect_right(starts, n) - 1, []
    for c in (own, own + 1):
        differ = 2 * (starts[c + 1] - 1) * (100 - percent) // (100 + percent)
        if differ and (c == own or 100 * n >= percent * starts[c]):
            ends = np.concatenate([[0], np.searchsorted(grams, _cuts(differ + 1)), [n]])
            with np.errstate(over="ignore"):
                key = (sums[ends[1:]] - sums[ends[:-1]]) ^ (np.arange(c << 32, (c << 32) + differ + 1, dtype=np.uint64) * _ODD[4])
                out.append((key ^ (key >> np.uint64(32))) * _ODD[5])
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def rarest_keys(doc: np.ndarray, grams: np.ndarray, counts: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (indexes of sizes) and keys, of which two sets that link share one at least. ``grams`` are those that more than
    one set has, each with its document and how many have it; the others of a document's ``sizes`` come before them."""
    order = np.lexsort((grams, counts, doc))
    doc, grams = doc[order], grams[order]
    shared = np.bincount(doc, minlength=len(sizes))
    rank = np.arange(len(doc)) - (np.cumsum(shared) - shared)[doc]
    first = sizes - (sizes * percent + 99) // 100 + 1 - (sizes - shared)
    kept = rank < first[doc]
    doc, grams = doc[kept], grams[kept]
    starts, n = np.array(size_classes(percent)), sizes[doc]
    own, docs, keys = np.searchsorted(starts, n, "right") - 1, [], []
    for c in (own, own + 1):
        differ = 2 * (starts[c + 1] - 1) * (100 - percent) // (100 + percent)
        some = (differ > 0) & ((c == own) | (100 * n >= percent * starts[c]))
        key = (grams[some] * _ODD[3]) ^ (c[some].astype(np.uint64) * _ODD[4])
        docs.append(doc[some])
        keys.append((key ^ (key >> np.uint64(32))) * _ODD[5])
    return np.concatenate(docs), np.concatenate(keys).view(np.int64)


def _rarest(source: DataFrame, n: int, percent: int, held: Held) -> tuple[DataFrame, str, DataFrame]:
    """A table with uid, doc_id, n and class of each row of source (doc_id, text), its path, and keys (uid, key) by rarity.

    N-grams travel in slices of some documents, cut into buckets by their leading bits: 48 bits of an n-gram and the document's place in
    its slice are one number. N-grams that agree in 48 bits are counted and keyed as one, which only adds keys in common."""
    chars = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(source.sparkSession), chars // (WORD_CHARS * BUCKET_GRAMS) + 1)
    cuts = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64) & ~_LOW

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("grams")
        nr, at, size, packed = TaskContext.get().partitionId() << 32, 0, 0, []

        def slice_() -> pa.RecordBatch:
            all_ = np.sort(np.concatenate(packed))
            ends = np.concatenate([[0], np.searchsorted(all_, cuts), [len(all_)]])
            some = np.flatnonzero(ends[1:] > ends[:-1])
            blobs = [all_[ends[b] : ends[b + 1]].tobytes() for b in some]
            none = pa.nulls(len(some), pa.int64())
            return pa.record_batch([pa.array(some, pa.int64()), none, none, pa.nulls(len(some), pa.binary()), pa.array([nr] * len(some), pa.int64()), none, pa.array(blobs, pa.binary())], names=CUT)

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [gram_set(x.as_py(), n) for x in part.column(1)]
                nrs, ats, full = [], [], []
                for s in sets:
                    packed.append((s & ~_LOW) | np.uint64(at))
                    nrs.append(nr)
                    ats.append(at)
                    at, size = at + 1, size + len(s)
                    if at == SLICE_DOCS or size >= SLICE_GRAMS:
                        full.append(slice_())
                        nr, at, size, packed = nr + 1, 0, 0, []
                slices = pa.array(nrs, pa.int64())
                yield pa.record_batch([pa.array([(x + a) % buckets for x, a in zip(nrs, ats, strict=True)], pa.int64()), part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_hash(s) for s in sets], pa.binary()), slices, pa.array(ats, pa.int64()), pa.nulls(len(sets), pa.binary())], names=CUT)
                yield from full
        if size:
            yield slice_()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("rarest")
        nrs, blobs = [], []
        for batch in batches:
            docs = batch.filter(batch.column(6).is_null())
            if docs.num_rows:
                yield pa.record_batch([*docs.columns[1:], pa.nulls(docs.num_rows, pa.binary())], names=COUNTED)
            some = batch.filter(batch.column(6).is_valid())
            nrs += some.column(4).to_pylist()
            blobs += [np.frombuffer(x.as_py(), "<u8") for x in some.column(6)]
        if not blobs:
            return
        ends = np.cumsum([len(b) for b in blobs])
        all_ = np.concatenate(blobs)
        del blobs
        _, which, times = np.unique(all_ >> np.uint64(16), return_inverse=True, return_counts=True)
        counts = np.minimum(times, 0xFFFFFFFF).astype("<u4")[which]
        for nr, lo, hi in zip(nrs, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            shared = counts[lo:hi] > 1
            if shared.any():
                row = [None, None, None, nr, None, all_[lo:hi][shared].tobytes(), counts[lo:hi][shared].tobytes()]
                yield pa.record_batch([pa.array([x], f) for x, f in zip(row, (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=COUNTED)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("rarest")
        docs: dict[int, list] = defaultdict(list)
        blobs: dict[int, list] = defaultdict(list)
        for batch in batches:
            for uid, size, nr, at, blob, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if blob is None:
                    docs[nr].append((at, uid, size))
                else:
                    blobs[nr].append((np.frombuffer(blob, "<u8"), np.frombuffer(counts, "<u4")))
        for nr, some in blobs.items():
            uids, sizes = (np.array(x, np.int64) for x in list(zip(*sorted(docs[nr]), strict=True))[1:])
            all_, counts = (np.concatenate(x) for x in zip(*some, strict=True))
            doc, keys = rarest_keys((all_ & _LOW).astype(np.int64), all_ >> np.uint64(16), counts, sizes, percent)
            yield pa.record_batch({"uid": pa.array(uids[doc], pa.int64()), "key": pa.array(keys, pa.int64())})

    dealt = source.mapInArrow(cut, "bucket long, doc_id long, n long, class binary, slice long, at long, blob binary").repartition(buckets, "bucket")
    counted = dealt.mapInArrow(count, "doc_id long, n long, class binary, slice long, at long, blob binary, counts binary")
    whole, path = stored(counted.withColumn("uid", F.monotonically_increasing_id()), "signed")
    keys = whole.select("uid", "n", "slice", "at", "blob", "counts").repartition(buckets, "slice").mapInArrow(choose, "uid long, key long").distinct()
    return whole.where("at is not null"), path, held.keep(keys)


CUT = ["bucket", "doc_id", "n", "class", "slice", "at", "blob"]
COUNTED = [*CUT[1:], "counts"]


class Product:
    """The incidence matrix of some sets by the n-grams that two or more of them have, and rows of its product with its transpose."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        doc, grams = np.repeat(np.arange(len(sets)), self.sizes), np.concatenate(sets)
        order = np.argsort(grams)
        grams, doc = grams[order], doc[order]
        new = np.ones(len(grams) + 1, bool)
        new[1:-1] = grams[1:] != grams[:-1]
        shared = ~(new[:-1] & new[1:])  # n-grams of one set add to no overlap
        self.doc, at = doc[shared], np.cumsum(new[:-1][shared]) - 1
        #: Documents of each n-gram, and n-grams of each document.
        self.times = np.bincount(at) if len(at) else np.empty(0, np.int64)
        self.of_gram = np.concatenate([[0], np.cumsum(self.times)])
        self.gram = at[np.argsort(self.doc, kind="stable")]
        self.of_doc = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=len(sets)))])
        # columns that many documents have are multiplied as dense blocks, the others entry by entry
        frequent = np.flatnonzero(self.times > SPARSE)
        self.place = np.full(len(self.times), -1)
        self.place[frequent] = np.arange(len(frequent))
        self.frequent = len(frequent)

    def overlaps(self, rows: np.ndarray) -> np.ndarray:
        """How many n-grams each of these documents shares with each document."""
        n, many = len(self.sizes), self.of_doc[rows + 1] - self.of_doc[rows]
        grams = self.gram[np.repeat(self.of_doc[rows] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        row = np.repeat(np.arange(len(rows)), many)
        dense = self.frequent > 0 and len(rows) > FEW_ROWS
        if dense:
            rare = self.place[grams] < 0
            grams, row = grams[rare], row[rare]
        out, times = np.zeros(len(rows) * n, np.int64), self.times[grams]
        ends = np.cumsum(times)
        cuts = [0, *np.searchsorted(ends, np.arange(PAIRS, ends[-1] if len(ends) else 0, PAIRS)).tolist(), len(grams)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            t = times[lo:hi]
            entry = np.repeat(self.of_gram[grams[lo:hi]] - np.cumsum(t) + t, t) + np.arange(t.sum())
            out += np.bincount(np.repeat(row[lo:hi], t) * n + self.doc[entry], minlength=len(out))
        out = out.reshape(len(rows), n)
        if dense:
            place = np.repeat(self.place, self.times)
            for c in range(0, self.frequent, COLUMNS):
                mine = (place >= c) & (place < c + COLUMNS)
                block = np.zeros((n, COLUMNS), np.float32)
                block[self.doc[mine], place[mine] - c] = 1
                out += np.rint(block[rows] @ block.T).astype(np.int64)
        return out

    def links(self, rows: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of these documents and all pass the bound."""
        both = self.overlaps(rows)
        return (both > 0) & (100 * both >= percent * (self.sizes[rows, None] + self.sizes[None, :] - both))


def linked(rows: list[np.ndarray], cols: list[np.ndarray] | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of row and column sets (of row sets with each other, if cols is None) that link, for some rows at a time."""
    product, first = Product(rows if cols is None else [*rows, *cols]), 0 if cols is None else len(rows)
    for at in range(0, len(rows), TILE):
        a, b = np.nonzero(product.links(np.arange(at, min(at + TILE, len(rows))), percent)[:, first:])
        yield a + at, b


def spanning(sets: list[np.ndarray], first: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that link, enough to join what all linking pairs of the first sets with the others (of all sets, if there are no
    others) join. Some leaders' rows are multiplied first; after that, rows of the largest component need not be, as the rows of the others
    have their links to it."""
    product, n = Product(sets), len(sets)
    side, label = np.arange(n) >= first, np.arange(n)
    apart = lambda x: (side != side[x, None]) if first < n else np.ones((len(x), n), bool)

    def join(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for x, y in zip(*np.nonzero(product.links(rows, percent) & apart(rows) & (label != label[rows, None])), strict=True):
            if label[rows[x]] != label[y]:
                old, new = max(label[rows[x]], label[y]), min(label[rows[x]], label[y])
                label[label == old] = new
                yield rows[x : x + 1], np.array([y])

    led = np.zeros(n, bool)
    for _ in range(LEADERS):
        rest = np.flatnonzero(~np.isin(label, label[led]))
        if not len(rest):
            break
        led[rest[0]] = True
        yield from join(rest[:1])
    largest = np.bincount(label).argmax() if n else 0
    rest = np.flatnonzero((label != largest) & ~led)
    for at in range(0, len(rest), TILE):
        yield from join(rest[at : at + TILE])


def _forest(uid: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Links that join the same documents as all pairs of indexes of uid do."""
    root, out = list(range(len(uid))), []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            rx, ry = x, y
            while root[rx] != rx:
                root[rx] = rx = root[root[rx]]
            while root[ry] != ry:
                root[ry] = ry = root[root[ry]]
            if rx != ry:
                root[max(rx, ry)] = min(rx, ry)
                out.append((uid[x], uid[y]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _block(percent: int):
    """Links in a block, or between its two sides where there are two; leaders are side 1."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        worker.enter("blocks")
        pdf = pdf.drop_duplicates(["uid", "side"]).sort_values(["side", "uid"], ignore_index=True)
        sets, uid = [np.frombuffer(x, "<u8") for x in pdf.grams], pdf.uid.to_numpy()
        first = int((pdf.side == 0).sum())
        return _forest(uid, spanning(sets, first, percent))

    return run


def _families(wanted: DataFrame, members: DataFrame, sets_of, percent: int, held: Held) -> DataFrame:
    """Links (a, b) of row ids among the sets of families. ``wanted`` has family, uid, n and class; sets_of(rows) adds the
    sets (grams) to rows with a class. Sets travel only to where they are multiplied."""
    sizes = wanted.groupBy("family").agg(F.count("*").alias("m"), F.sum("n").alias("grams_all"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("grams_all") / BLOCK_GRAMS))
    sizes = held.keep(sizes.select("family", blocks.alias("blocks"), "m"))
    wanted = held.keep(joined(wanted, sizes.select("family", "blocks"), "family", sizes.select("family", F.col("m").alias("c"))))
    alone = sets_of(wanted.where("blocks = 1").select("class", "family", "uid", F.lit(0).alias("side")))
    small = held.keep(alone.groupBy("family").applyInPandas(_block(percent), "a long, b long"))
    big = wanted.where("blocks > 1")
    if not big.take(1):
        return small
    sets = held.keep(sets_of(big.select("class", "uid")).select("uid", "grams"))
    big = big.withColumn("block", F.expr("pmod(xxhash64(uid), blocks)"))
    copies = members.groupBy(F.col("rep").alias("uid")).agg(F.count("*").alias("copies"))
    ranks = big.join(copies, "uid").withColumn("r", F.expr("row_number() over (partition by family order by copies desc, n desc, uid)"))
    leaders = ranks.where(F.col("r") <= LEADERS).select("family", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), "uid", F.lit(1).alias("side"))
    star_rows = big.select("family", "block", "uid", F.lit(0).alias("side")).unionByName(leaders)
    star = held.keep(star_rows.join(sets, "uid").groupBy("family", "block").applyInPandas(_block(percent), "a long, b long"))
    found = components(star)
    big = big.join(found.select(F.col("node").alias("uid"), "label"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    size = big.groupBy("label").agg(F.count("*").alias("c"), F.sum("n").alias("g"))
    pieces = F.greatest(F.ceil(F.col("c") / BLOCK_DOCS), F.ceil(F.col("g") / BLOCK_GRAMS))
    size = held.keep(size.select("label", "c", F.when(F.col("c") * 4 >= BLOCK_DOCS, pieces).alias("pieces")))
    big = joined(big, size.select("label", "pieces"), "label", size.select("label", "c"))
    # a block of one component is never multiplied with another of the same; the rest share blocks, dealt by hash
    mixed = F.expr("struct(-1L as of, pmod(xxhash64(uid), blocks) as nr)")
    pure = F.expr("struct(label as of, pmod(xxhash64(uid), pieces) as nr)")
    big = held.keep(big.withColumn("part", F.when(F.col("pieces").isNotNull(), pure).otherwise(mixed)).select("family", "part", "uid"))
    parts = big.select("family", "part").distinct()
    pairs = parts.join(parts.withColumnRenamed("part", "q"), "family").where("part <= q and not (part.of = q.of and part.of >= 0)")
    pairs = pairs.selectExpr("family", "part", "q", "explode(if(part = q, array(0), array(0, 1))) side").withColumn("mine", F.expr("if(side = 0, part, q)"))
    sides = pairs.join(big.withColumnRenamed("part", "mine"), ["family", "mine"]).select("family", "part", "q", "side", "uid").join(sets, "uid")
    cross = sides.groupBy("family", "part", "q").applyInPandas(_block(percent), "a long, b long")
    return small.unionByName(star).unionByName(cross)


def join_components(docs: DataFrame, n: int = 3, percent: int = 90, broadcast_rows: int = 250_000, broadcast_keys: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles and component_id for each row. The ids of documents in families are broadcast up to
    ``broadcast_rows`` of them, keys that several sets have and ids of exact copies up to
    ``broadcast_keys``; beyond, they are joined by a shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    held = Held()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("grams")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [gram_set(x.as_py(), n) for x in part.column(1)]
                yield pa.record_batch({"doc_id": part.column(0), "n": pa.array([len(s) for s in sets], pa.int64()), "class": pa.array([class_hash(s) for s in sets], pa.binary()), "keys": pa.array([part_keys(s, percent) for s in sets], pa.list_(pa.int64()))})

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    if percent < RARE_BELOW:
        signed, signed_path, keyed = _rarest(source, n, percent, held)
    else:
        signed, signed_path = stored(source.mapInArrow(keys, "doc_id long, n long, class binary, keys array<long>").withColumn("uid", F.monotonically_increasing_id()), "signed")
        keyed = signed.select("uid", F.explode("keys").alias("key"))
    rows = signed.select("uid", "doc_id", "n", F.when(F.col("n") > 0, F.col("class")).alias("class"))
    classes = held.keep(rows.where("class is not null").groupBy("class").agg(F.min("uid").alias("rep"), F.count("*").alias("c")))
    members = held.keep(joined(rows, classes.select("class", "rep"), "class", classes.select("class", "c")).withColumn("rep", F.coalesce("rep", "uid")))
    copies = members.where("uid != rep").select("uid")
    copies = F.broadcast(copies) if copies.count() <= broadcast_keys else copies
    exploded = keyed.join(copies, "uid", "left_anti")
    shared = held.keep(exploded.groupBy("key").agg(F.min("uid").alias("least"), F.count("*").alias("c")).where("c > 1"))
    least_of, few_keys = shared.select("key", "least"), shared.count() <= broadcast_keys
    meet = exploded.join(F.broadcast(least_of), "key") if few_keys else joined(exploded, least_of, "key", shared.select("key", "c"))
    meet = meet.where("uid != least").select(F.col("uid").alias("a"), F.col("least").alias("b"))
    families = components(meet).select(F.col("node").alias("uid"), F.col("label").alias("family"))

    wanted = held.keep(families.join(members.where("uid = rep"), "uid").select("uid", "family", "n", "doc_id", "class"))
    few = wanted.count() <= broadcast_rows
    maybe = F.broadcast if few else lambda df: df

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("grams")
        seen: set[bytes] = set()  # repeated rows would only repeat a set
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sets = [gram_set(x.as_py(), n) for x in batch.slice(at, 500).column(0)]
                new = {h: s for s in sets if len(s) and (h := class_hash(s)) not in seen}
                if len(seen) < WORDS_CACHED:
                    seen.update(new)
                yield pa.record_batch({"class": pa.array(list(new), pa.binary()), "grams": pa.array([s.tobytes() for s in new.values()], pa.binary())})

    def sets_of(rows: DataFrame) -> DataFrame:
        ids = maybe(wanted.join(rows.select("class"), "class", "left_semi").select("doc_id").distinct())
        texts = source.join(ids, source.doc_id.eqNullSafe(ids.doc_id), "left_semi").select("text")
        return texts.mapInArrow(grams, "class binary, grams binary").join(maybe(rows), "class").drop("class")

    links = _families(wanted, members, sets_of, percent, held)
    # what joins the documents: links between classes, and rows that are of one class or of one doc_id
    found = components(links).select(F.col("node").alias("rep"), "label")
    by_rep = joined(members, found, "rep", classes.select("rep", "c")).select("uid", "doc_id", "n", F.coalesce("label", "rep").alias("label"))
    by_rep = held.keep(by_rep)
    least = held.keep(by_rep.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("c")))
    out = table(joined(by_rep, least.select("label", "component_id"), "label", least.select("label", "c")).select("doc_id", F.col("n").alias("n_shingles"), "component_id"), "joined")
    held.release()
    drop(spark, signed_path)
    free(spark)
    return out
