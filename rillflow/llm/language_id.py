"""Language identification by interpolated Kneser-Ney character models.

A text becomes symbols: a letter of the first Unicode plane has its own, letters beyond share 2048, and a run of anything else is
one gap. A model per language gives the probability of a symbol after the three before it.

1. Each task counts 4-grams of its documents per language, and the counts are added up over the whole corpus. Lower orders
   need no scan: Kneser-Ney takes them from the distinct 4-grams. The letters seen there are the alphabet; an n-gram is a
   number of as many bits a symbol as the alphabet needs, and letters never seen share one symbol.
2. A language's model is sorted arrays of n-gram numbers with log probabilities and back-off weights, from all counts of the
   language. Languages whose models together have more than BROADCAST_ENTRIES 4-grams are dealt to several passes over the documents,
   and a language that has more than LANGUAGE_ENTRIES is cut by the symbol before the last, so that a 4-gram's shorter
   n-grams and contexts lie in its piece; whole-language statistics (discounts, single symbols) come from all counts. Sums are
   of whole numbers (2**-20 nats), so passes and pieces change nothing.
3. Texts are scored by cross-entropy per symbol under each language, the least winning. A batch looks up its distinct 4-grams
   by binary search and then only adds up.
4. No document is scored by a model that has counted it: each half of the training documents (by the id's checksum) is scored by models
   of the other half, all other documents by models of all counts. On the training documents, scores and rejection are
   calibrated: the share of right answers in bins of (gap to the second best language, times length), and the bound on
   cross-entropy that a share ``false_rate`` of them passes, after taking off mean and spread at their length. Documents far beyond
   all others, at most a share JUNK, are junk whatever their label, and left out of the bound.

Defined cases: a null text, or one without letters, is ``und`` with score 0; equal cross-entropies go to the language that
sorts first; with nothing to learn from, all is ``und``; where one half of the training documents has none, models of all counts score
the other; a null doc_id never trains and counts as held out; very long texts are scored whole; repeated rows come out repeated; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rillflow.llm import worker
from rillflow.llm.store import free, small_batches, table

ORDER, BITS, WIDE = 4, 6, 16
PAD = ORDER - 1
BATCH_SYMBOLS = 500_000
UNKNOWN = "und"
BROADCAST_ENTRIES, LANGUAGE_ENTRIES, CHUNK = 8_000_000, 1 << 24, 1_000_000
UNIT = 1 << 20


def _symbols() -> np.ndarray:
    """The symbol of each code point: 0 for what isn't a letter, 1-26 a-z, the code point of other letters, those of surrogates
    for letters beyond the first plane."""
    letters = np.array([i for i in range(0x110000) if chr(i).isalpha()])
    out = np.zeros(0x110000, np.uint16)
    out[letters] = np.where(letters < 1 << WIDE, letters, 0xD800 + letters % 2048)
    out[97:123] = np.arange(1, 27)
    return out


_table: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Without leading or trailing gaps; empty if no letter occurs."""
    if not _table:
        _table.append(_symbols())
    s = _table[0][np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")]
    keep = s > 0
    keep[1:] |= s[:-1] > 0
    s = s[keep]
    return s[:-1] if len(s) and s[-1] == 0 else s


class Alphabet:
    """The symbols of fewer bits that letters have in models: by rank among the letters seen, one for all others."""

    def __init__(self, seen: np.ndarray):
        seen = np.sort(seen[seen > 0])
        self.bits = max(BITS, (len(seen) + 1).bit_length())
        self.rank = np.full(1 << WIDE, len(seen) + 1, np.uint16)
        self.rank[0], self.rank[seen] = 0, np.arange(1, len(seen) + 1)

    def packed(self, wide: np.ndarray) -> np.ndarray:
        """Codes of WIDE bits a symbol as codes of this alphabet."""
        out = np.zeros(len(wide), np.int64)
        for k in range(ORDER):
            out |= self.rank[wide >> (WIDE * k) & 0xFFFF].astype(np.int64) << (self.bits * k)
        return out.astype(np.int32) if self.bits * ORDER < 32 else out


def codes(docs: list[np.ndarray], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each symbol of each document (and at a closing gap), and where each document starts in them."""
    pad, gap = np.zeros(PAD, np.uint16), np.zeros(1, np.uint16)
    sizes = np.array([len(d) + 1 for d in docs])
    s = np.concatenate([x for d in docs for x in (pad, d, gap)]).astype(np.int32 if bits * ORDER < 32 else np.int64)
    code = s[PAD:].copy()
    for k in range(1, ORDER):
        code |= s[PAD - k : len(s) - k] << (bits * k)
    firsts = np.cumsum(sizes) - sizes
    inside = np.ones(len(code), bool)
    breaks = np.cumsum(sizes + PAD)[:-1] - PAD
    for k in range(PAD):
        inside[breaks + k] = False
    return code[inside], firsts


class Distinct:
    """Finds the distinct codes of a batch, sorted, and each code's place in them. Codes of 6 bits a symbol need no sorting; the
    tables for that (48 MB) live as long as a task."""

    def __init__(self) -> None:
        self.seen, self.place = np.zeros(1 << (BITS * ORDER), bool), np.empty(1 << (BITS * ORDER), np.uint16)

    def __call__(self, code: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
        if bits > BITS:
            return np.unique(code, return_inverse=True)
        self.seen[code] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        if len(found) > 1 << 16:
            return found, np.searchsorted(found, code)
        self.place[found] = np.arange(len(found), dtype=np.uint16)
        return found, self.place[code]


def discount(counts: np.ndarray) -> float:
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    return _discount(n1, n2)


def _discount(n1: int, n2: int) -> float:
    return min(0.9, max(0.1, n1 / max(1, n1 + 2 * n2)))


class Model:
    """One language, or a piece of one. grams[k] has the sorted numbers of its (k + 1)-grams, logp[k] their log probabilities, back[k]
    the log weight that their continuations leave to shorter contexts.

    A piece has the 4-grams whose last symbol but one is among some symbols, for which ``part`` is true; ``whole`` has what it can't
    know: single symbols with their continuation counts, and each order's discount."""

    def __init__(self, code: np.ndarray, count: np.ndarray, least: int = 1, bits: int = BITS, whole: tuple[np.ndarray, np.ndarray, list[float]] | None = None, part: np.ndarray | None = None):
        self.bits, mask = bits, (1 << bits) - 1
        order = np.argsort(code)
        grams, counts = [code[order]], [count[order]]
        del order
        for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many distinct contexts a shorter gram occurs
            g, c = np.unique(grams[0] & ((1 << (bits * k)) - 1), return_counts=True)
            grams.insert(0, g)
            counts.insert(0, c)
        self.part = part
        if whole:
            grams[0], counts[0] = whole[0].astype(code.dtype), whole[1]
        self.grams, self.logp, self.back = [], [], []
        base = np.full(1 << bits, 1 / (1 << bits))
        lower = lambda g: base[g]
        for k, (g, c) in enumerate(zip(grams, counts, strict=True)):
            d = whole[2][k] if whole else discount(c)
            p, logp, contexts, back, start = np.empty(len(g) if k < ORDER - 1 else 0), np.empty(len(g), np.float32), [], [], 0
            while start < len(g):  # whole contexts, some at a time
                stop = min(start + CHUNK, len(g))
                stop = int(np.searchsorted(g, (int(g[stop - 1]) >> bits) + 1 << bits)) if stop < len(g) else stop
                x, n = g[start:stop], c[start:stop].astype(np.float64)
                some, at, kinds = np.unique(x >> bits, return_inverse=True, return_counts=True)
                total = np.bincount(at, n)
                weight = d * kinds / total
                own = (n - d) / total[at] + weight[at] * lower(x & ((1 << (bits * k)) - 1) if k else x & mask)
                logp[start:stop] = np.log(own)
                if k < ORDER - 1:
                    p[start:stop] = own
                contexts.append(some)
                back.append(np.log(weight).astype(np.float32))
                start = stop
            kept = c >= least if k == ORDER - 1 else np.ones(len(g), bool)
            self.grams.append(g[kept])
            self.logp.append(logp[kept])
            self.back.append((np.concatenate(contexts), np.concatenate(back)))
            lower = lambda x, g=g, p=p: self._exact(x, g, p)

    @staticmethod
    def _exact(x: np.ndarray, g: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Every suffix of a seen gram is itself seen."""
        return p[np.searchsorted(g, x)]

    def scores(self, code: np.ndarray) -> np.ndarray:
        """Log probabilities of the last symbols of 4-grams, by binary search, backing off where a gram is missing; 0 for 4-grams
        of other pieces."""
        bits, code, out = self.bits, code.astype(self.grams[-1].dtype), np.zeros(len(code), np.float32)
        mine = np.arange(len(code)) if self.part is None else np.flatnonzero(self.part[code >> bits & (1 << bits) - 1])
        open_ = mine
        for k in range(ORDER - 1, -1, -1):
            g = code[open_] & ((1 << (bits * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], g), len(self.grams[k]) - 1)
            hit = self.grams[k][at] == g
            out[open_[hit]] += self.logp[k][at[hit]]
            open_, g = open_[~hit], g[~hit]
            contexts, weight = self.back[k]
            at = np.minimum(np.searchsorted(contexts, g >> bits), len(contexts) - 1)
            known = contexts[at] == g >> bits
            out[open_[known]] += weight[at[known]]
        out[open_] += np.float32(-np.log(1 << bits))
        return out


def _in_batches(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple[list[np.ndarray], list[list]]]:
    """Documents' symbols and the values of other columns, so many at once as have BATCH_SYMBOLS symbols."""
    docs, values, size = [], [[] for _ in columns], 0
    for batch in batches:
        for text, *rest in zip(batch.column(0), *(batch.column(c).to_pylist() for c in columns), strict=True):
            docs.append(symbols(text.as_py() or ""))
            for v, x in zip(values, rest, strict=True):
                v.append(x)
            size += len(docs[-1]) + ORDER
            if size >= BATCH_SYMBOLS:
                yield docs, values
                docs, values, size = [], [[] for _ in columns], 0
    if docs:
        yield docs, values


def count_grams(texts: DataFrame, back: Column | None = None) -> DataFrame:
    """lang, code (of WIDE bits a symbol), n, and n_fit (without rows that are held back) of a table of text and lang."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("languages")
        distinct = Distinct()
        for docs, (langs, backs) in _in_batches(batches, 1, 2):
            by: dict[tuple[str, bool], list[np.ndarray]] = defaultdict(list)
            for d, lang, held in zip(docs, langs, backs, strict=True):
                if len(d):
                    by[lang, held].append(d)
            # the batch's own symbols are few as a rule, and few bits need no sorting
            used = np.bincount(np.concatenate(docs), minlength=1 << WIDE) > 0
            used[0] = True
            used = np.flatnonzero(used)
            own, bits = np.zeros(1 << WIDE, np.uint16), max(BITS, (len(used) - 1).bit_length())
            own[used] = np.arange(len(used))
            for (lang, held), some in by.items():
                found, at = distinct(codes([own[d] for d in some], bits)[0], bits)
                wide = np.zeros(len(found), np.int64)
                for k in range(ORDER):
                    wide |= used[found >> (bits * k) & (1 << bits) - 1] << (WIDE * k)
                n = np.bincount(at)
                yield pa.record_batch({"lang": pa.array([lang] * len(found), pa.string()), "code": pa.array(wide, pa.int64()), "n": pa.array(n, pa.int64()), "n_fit": pa.array(n * (not held), pa.int64())})

    rows = texts.select("text", "lang", (F.lit(False) if back is None else back).alias("back"))
    return rows.mapInArrow(task, "lang string, code long, n long, n_fit long").groupBy("lang", "code").agg(F.sum("n").alias("n"), F.sum("n_fit").alias("n_fit"))


def _sizes(counts: DataFrame) -> dict[str, int]:
    return {r.lang: r.c for r in counts.groupBy("lang").agg(F.count("*").alias("c")).collect()}


def alphabet_of(counts: DataFrame) -> Alphabet:
    """Of the letters of training documents, at most 65,536."""
    return Alphabet(np.array([r.s for r in counts.select(F.expr("code & 65535").alias("s")).distinct().collect()], np.int64))


class Counts:
    """4-gram counts (lang, code, n) and what models of them share."""

    def __init__(self, table_: DataFrame, alphabet: Alphabet):
        self.table, self.alphabet, self.sizes = table_, alphabet, _sizes(table_)

    def _arrays(self, some: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        got = some.select("code", "n").toArrow()
        return self.alphabet.packed(got.column("code").to_numpy()), got.column("n").to_numpy()

    def model(self, lang: str, least: int = 1) -> Model:
        return Model(*self._arrays(self.table.where(F.col("lang") == lang)), least, self.alphabet.bits)

    def pieces(self, lang: str) -> list[list[int]]:
        """Symbols by piece; a piece has more than LANGUAGE_ENTRIES 4-grams only where one symbol alone has more before last ones."""
        per = self.table.where(F.col("lang") == lang).groupBy(F.expr("shiftright(code, 16) & 65535").alias("s")).agg(F.count("*").alias("c")).collect()
        return shards({r.s: r.c for r in per}, LANGUAGE_ENTRIES)

    def piece(self, lang: str, pieces: list[list[int]], nr: int, whole: tuple[np.ndarray, np.ndarray, list[float]]) -> Model:
        """Symbols that are in none of the pieces belong to the first."""
        symbols_, part = pieces[nr], np.full(1 << self.alphabet.bits, nr == 0)
        for other in pieces[1:]:
            part[self.alphabet.rank[other]] = other is symbols_
        sent = self.table.sparkSession.createDataFrame([(s,) for s in symbols_], "s long")
        mine = self.table.where(F.col("lang") == lang).withColumn("s", F.expr("shiftright(code, 16) & 65535")).join(F.broadcast(sent), "s", "left_semi")
        return Model(*self._arrays(mine), 1, self.alphabet.bits, whole, part)

    def whole(self, lang: str) -> tuple[np.ndarray, np.ndarray, list[float]]:
        """Single symbols, their continuation counts, and each order's discount, from all counts of a language."""
        orders = [self.table.where(F.col("lang") == lang).select("code", "n")]
        for k in range(ORDER - 1, 0, -1):
            orders.insert(0, orders[0].groupBy(F.expr(f"code & {(1 << WIDE * k) - 1}L").alias("code")).agg(F.count("*").alias("n")))
        ones = [o.agg(F.sum((F.col("n") == 1).cast("long")).alias("a"), F.sum((F.col("n") == 2).cast("long")).alias("b")).first() for o in orders]
        code, n = self._arrays(orders[0])
        order = np.argsort(code)
        return code[order], n[order], [_discount(r.a, r.b) for r in ones]


def train(texts: DataFrame, model_entries: int | None = None) -> Models:
    """Models of a table of text and lang (both not null), from all counts. With ``model_entries``, 4-grams below a power of two that
    is as low as this allows are then left out of the models; discounts and lower orders still come from all."""
    counts = table(count_grams(texts), "grams")
    have, least = Counts(counts, alphabet_of(counts)), 1
    while model_entries is not None and counts.where(F.col("n") >= least).count() > model_entries:
        least *= 2
    return Models(have.alphabet, {x: have.model(x, least) for x in sorted(have.sizes)})


class Models(dict):
    """Models of one alphabet by language."""

    def __init__(self, alphabet: Alphabet, models: dict[str, Model]):
        super().__init__(models)
        self.alphabet = alphabet

    def __reduce__(self):
        return Models, (self.alphabet, dict(self))

    def sums(self, docs: list[np.ndarray], distinct: Distinct) -> np.ndarray:
        """Minus the log probability of each document (none empty) under each language, in units."""
        rank, bits = self.alphabet.rank, self.alphabet.bits
        code, firsts = codes([rank[d] for d in docs], bits)
        found, at = distinct(code, bits)
        each = [-np.rint(self[x].scores(found).astype(np.float64) * UNIT).astype(np.int64) for x in sorted(self)]
        return np.stack([np.add.reduceat(x[at], firsts) for x in each])


def shards(size: dict[str, int], entries: int) -> list[list[str]]:
    """Languages by the pass that scores them; more than ``entries`` 4-grams only where one language alone has more."""
    out, room = [], 0
    for x in sorted(size):
        if not out or size[x] > room:
            out.append([])
            room = entries
        out[-1].append(x)
        room -= size[x]
    return out


SCORED = "lang_pred string, entropy double, second double, n_symbols long"


def score(docs: DataFrame, models: Models, text: str = "text", *keep: str) -> DataFrame:
    """The columns ``keep`` with the best language, its cross-entropy per symbol, the second best's more, and the symbols."""
    return _lead(_best_two(docs, models, text, *keep), *keep)


def _lead(scored: DataFrame, *keep: str) -> DataFrame:
    alone = F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(1.0)
    return scored.select(*keep, "lang_pred", "entropy", F.coalesce(F.col("second") - F.col("entropy"), alone).alias("lead"), "n_symbols")


def score_all(docs: DataFrame, counts: Counts, text: str = "text", *keep: str) -> DataFrame:
    """Like :func:`score` under the models of all languages of ``counts``, in as many passes as their size asks for. The text of
    documents is written once more where there are several."""
    large = [x for x in sorted(counts.sizes) if counts.sizes[x] > LANGUAGE_ENTRIES]
    groups = shards({x: n for x, n in counts.sizes.items() if x not in large}, BROADCAST_ENTRIES)
    models = lambda some: Models(counts.alphabet, {x: counts.model(x) for x in some})
    if len(groups) < 2 and not large:
        return score(docs, models([x for group in groups for x in group]), text, *keep)
    nr = "row_"
    while nr in docs.columns:
        nr += "_"
    rows = table(docs.select(text, *keep).withColumn(nr, F.monotonically_increasing_id()), "numbered")
    parts = [table(_best_two(rows, models(group), text, nr), "scored") for group in groups]
    for lang in large:
        whole, pieces = counts.whole(lang), counts.pieces(lang)
        some = [table(_sums(rows, Models(counts.alphabet, {lang: counts.piece(lang, pieces, i, whole)}), text, nr), "pieces") for i in range(len(pieces))]
        all_ = reduce(DataFrame.unionByName, some).groupBy(nr).agg((F.sum("total") / UNIT).alias("e"), F.max("n_symbols").alias("n_symbols"))
        known = F.col("n_symbols") > 0
        entropy = F.when(known, F.col("e") / (F.col("n_symbols") + 1)).otherwise(0.0)
        parts.append(all_.select(nr, F.when(known, lang).otherwise(UNKNOWN).alias("lang_pred"), entropy.alias("entropy"), F.lit(None).cast("double").alias("second"), "n_symbols"))
    found = reduce(DataFrame.unionByName, parts)
    first, second = F.struct(F.col("entropy").alias("e"), F.col("lang_pred").alias("l")), F.struct(F.col("second").alias("e"), F.lit("\U0010ffff").alias("l"))
    both = F.when(F.col("second").isNull(), F.array(first)).otherwise(F.array(first, second))
    merged = found.groupBy(nr).agg(F.array_sort(F.flatten(F.collect_list(both))).alias("all"), F.max("n_symbols").alias("n_symbols"))
    known = F.col("n_symbols") > 0
    merged = merged.select(nr, F.col("all")[0]["l"].alias("lang_pred"), F.col("all")[0]["e"].alias("entropy"), F.when(known, F.get("all", F.lit(1))["e"]).alias("second"), "n_symbols")
    return _lead(rows.drop(text).join(merged, nr), *keep)


def _sums(docs: DataFrame, models: Models, text: str, nr: str) -> DataFrame:
    """total, in units, under the only model of ``models``."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("languages")
        distinct = Distinct()
        for docs_, (nrs,) in _in_batches(batches, 1):
            n = np.array([len(d) for d in docs_])
            total = np.zeros(len(n), np.int64)
            if (n > 0).any():
                total[n > 0] = sent.value.sums([d for d in docs_ if len(d)], distinct)[0]
            yield pa.record_batch({nr: pa.array(nrs, pa.int64()), "total": pa.array(total), "n_symbols": pa.array(n, pa.int64())})

    return docs.select(F.col(text).cast("string"), nr).mapInArrow(task, f"`{nr}` long, total long, n_symbols long")


def _best_two(docs: DataFrame, models: Models, text: str, *keep: str) -> DataFrame:
    names, sent = sorted(models), docs.sparkSession.sparkContext.broadcast(models)
    kept = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.enter("languages")
        distinct = Distinct()
        for docs_, values in _in_batches(batches, *range(1, 1 + len(keep))):
            n = np.array([len(d) for d in docs_])
            some = [d for d in docs_ if len(d)]
            best, second, who = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), int)
            if some and names:
                each = sent.value.sums(some, distinct) / UNIT / (n[n > 0] + 1)
                who[n > 0] = each.argmin(0)
                each.sort(0)
                best[n > 0], second[n > 0] = each[0], each[min(1, len(names) - 1)]
            known = (n > 0) & bool(names)
            pred = [names[w] if k else UNKNOWN for w, k in zip(who.tolist(), known.tolist(), strict=True)]
            own = [pa.array(v, f) for v, f in zip(values, kinds, strict=True)]
            yield pa.record_batch([*own, pa.array(pred, pa.string()), pa.array(best), pa.array(second, mask=~known | (len(names) < 2)), pa.array(n, pa.int64())], names=[*keep, "lang_pred", "entropy", "second", "n_symbols"])

    kinds = [f.type for f in to_arrow_schema(kept)]
    return docs.select(F.col(text).cast("string"), *keep).mapInArrow(task, f"{fields}, {SCORED}" if fields else SCORED)


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(True))


def _bin() -> Column:
    """Of the lead in nats over a whole text, by steps of a tenth of a power of two."""
    return F.least(F.lit(300), F.floor(10 * F.log2(1 + F.col("lead") * (F.col("n_symbols") + 1))))


class Calibration:
    """right[bin]: share of right answers; a text of n symbols is rejected if its cross-entropy is more than ``bound`` spreads above the
    mean. The mean is a line in 1 / (n + 1), the squared spread another, and the bound the cross-entropy's rank that a share
    ``false_rate`` of the documents passes; with too few documents for that, the largest or the normal distribution's, if more. At most a share JUNK of the documents is left out
    where those come after a gap: twice as far off as all others and as the normal distribution's bound. Without documents nothing
    is rejected."""

    def __init__(self, scored: DataFrame, false_rate: float):
        known = scored.where("lang is not null and n_symbols > 0")
        # bounded histograms: 301 bins of lead, and hundredths of a spread up to BINS
        lead = known.groupBy(_bin().alias("bin")).agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()
        n, right = np.zeros(301), np.zeros(301)
        for r in lead:
            n[int(r.bin)], right[int(r.bin)] = r.n, r.right
        # pool adjacent bins until shares never fall with the lead
        pools: list[list[float]] = []
        for b in range(301):
            pools.append([right[b], n[b], 1])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
        self.right = np.concatenate([np.full(int(k), (a + 0.5) / (b + 1) if b else 0.0) for a, b, k in pools])
        self.n, x, e = int(n.sum()), 1 / (F.col("n_symbols") + 1.0), F.col("entropy")
        self.mean = self._line(known, x, e)
        off = e - self.mean[0] - self.mean[1] * x
        self.spread = self._line(known, x, off * off, falls=False)
        hist = sorted((r.z, r.c) for r in known.groupBy(F.least(F.lit(BINS), F.ceil(100 * self.passed())).alias("z")).agg(F.count("*").alias("c")).collect())
        self.bound, above = NormalDist().inv_cdf(1 - false_rate), 0
        for i in range(len(hist) - 1, 0, -1):
            above += hist[i][1]
            if above > JUNK * self.n:
                break
            if hist[i][0] >= 2 * max(hist[i - 1][0], 100 * self.bound):
                hist = hist[:i]
                break
        rank, upto = math.ceil((sum(c for _, c in hist) + 1) * (1 - false_rate)), 0
        for z, c in hist:
            upto += c
            if upto >= rank or z == hist[-1][0]:
                self.bound = z / 100 if upto >= rank else max(self.bound, z / 100)
                break
        if not self.n:
            self.bound = math.inf

    @staticmethod
    def _line(rows: DataFrame, x: Column, y: Column, falls: bool = True) -> tuple[float, float]:
        """Least squares of y by x: the value at 0, and the slope; neither under 0 unless the line may fall."""
        r = rows.agg(F.avg(x).alias("x"), F.avg(y).alias("y"), F.avg(x * x).alias("xx"), F.avg(x * y).alias("xy")).first()
        if r.x is None:
            return 0.0, 0.0
        wide = r.xx - r.x * r.x
        slope = (r.xy - r.x * r.y) / wide if wide > 1e-12 else 0.0
        if not falls:
            slope = min(max(slope, 0.0), r.y / r.x)
        return r.y - slope * r.x, slope

    def passed(self) -> Column:
        """Spreads above the mean."""
        x = 1 / (F.col("n_symbols") + 1.0)
        spread = F.greatest(self.spread[0] + self.spread[1] * x, F.lit(LEAST_SPREAD**2))
        return (F.col("entropy") - self.mean[0] - self.mean[1] * x) / F.sqrt(spread)

    def score(self) -> Column:
        shares = F.array(*[F.lit(float(x)) for x in self.right])
        return F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(F.get(shares, _bin().cast("int")))


BINS, LEAST_SPREAD, JUNK = 100_000, 0.01, 0.02


def identify(docs: DataFrame, false_rate: float = 0.0005, *keep: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of right answers among documents of like lead that the scoring models hadn't seen),
    entropy, rejected, and the columns ``keep``. Rejected are texts without letters and those whose cross-entropy lies so far above the
    mean at their length as a share ``false_rate`` of training documents do under models that haven't counted them: they look like none
    of the languages."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), *keep).withColumn("held_out", held_out())
    small_batches(docs.sparkSession)
    learned = F.expr("not held_out and lang is not null and text is not null")
    half = F.when(learned, F.when(fold("doc_id") > 2, "b").otherwise("a")).otherwise("")
    rows = rows.withColumn("half", half)
    counts = table(count_grams(rows.where("half != ''"), F.col("half") == "b"), "grams")
    alphabet = alphabet_of(counts)
    of = {"": counts, "a": counts.withColumn("n", F.col("n") - F.col("n_fit")), "b": counts.withColumn("n", F.col("n_fit"))}
    of = {h: Counts(df.where("n > 0").select("lang", "code", "n"), alphabet) for h, df in of.items()}
    if not (of["a"].sizes and of["b"].sizes):
        of["a"] = of["b"] = of[""]
    kept = ["doc_id", "lang", "held_out", "half", *keep]
    scored = reduce(DataFrame.unionByName, [table(score_all(rows.where(F.col("half") == h), c, "text", *kept), "scored") for h, c in of.items()])
    fit = Calibration(scored.where("half != ''"), false_rate)
    rejected = (F.col("lang_pred") == UNKNOWN) | (fit.passed() > F.lit(fit.bound))
    free(docs.sparkSession)
    return scored.select("doc_id", "held_out", "lang_pred", fit.score().alias("score"), "entropy", rejected.alias("rejected"), *keep)
