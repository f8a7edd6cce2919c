"""Candidates and recall on natural word frequencies, short and unspaced items, blocks, and odd places."""

import random

import numpy as np
import pytest
from test_decontamination import distance

from rillflow.llm import decontamination as dc

rng = np.random.default_rng(4)
ZIPF = 1 / np.arange(1, 20_001)
WORDS = np.array([f"w{i}" for i in range(20_000)])


def draw(n):
    return WORDS[rng.choice(20_000, n, p=ZIPF / ZIPF.sum())].tolist()


def edited(r, w):
    w = list(w)
    for _ in range(dc.allowed_edits(len(w), 0.2)):
        at, kind = r.randrange(len(w)), r.randrange(3)
        if kind == 0:
            w[at] = draw(1)[0]
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, draw(1)[0])
    return w


@pytest.fixture(scope="module")
def made():
    items = [(i, " ".join(draw(int(n)))) for i, n in enumerate(rng.integers(12, 70, 2000))]
    return items, dc.Index(items, 0.2, 5, 0.99)


def test_few_candidates_and_high_recall_on_natural_frequencies(made):
    items, index = made
    docs = [(d, [index.symbol.get(w, index.strange) for w in draw(20_000)]) for d in range(3)]
    flat = np.array([x for _, d in docs for x in [*d, *[index.strange] * index.gap]] + [index.strange] * index.tail, np.int64)
    firsts = np.array([0, 20_000 + index.gap, 2 * (20_000 + index.gap)])
    n = sum(len(some) for c, h in zip(index.classes, index.seeds.hits(flat, firsts), strict=True) for some in c.candidates(flat, h))
    assert n <= 0.1 * 60_000  # 24 a word without the bounds
    assert all(c.recall >= 0.99 for c in index.classes) and max(len(c.rounds) for c in index.classes) <= dc.MOST_ROUNDS
    r, planted = random.Random(8), []
    for d in range(400):
        item, text = items[r.randrange(len(items))]
        body, w = draw(300), edited(r, text.split())
        at = r.choice([0, 300, r.randrange(300)])  # at either end as well
        body[at:at] = w
        planted.append((d, item, body))
    found = {(d, i) for d, i, *_ in index.leaks([(d, [index.symbol.get(w, index.strange) for w in b]) for d, _, b in planted])}
    assert np.mean([(d, i) in found for d, i, _ in planted]) >= 0.98
    for d, i, b in planted[:25]:  # what is found is within the edits, and where
        assert ((d, i) not in found) or distance(items[i][1].split(), b) <= dc.allowed_edits(len(items[i][1].split()), 0.2)


def leaks(spark, docs, items, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in dc.leaks(df, spark.createDataFrame(items, "item_id long, text string"), **how).collect()}


def test_short_and_unspaced_items(spark):
    items = [(1, "photosynthesis thermodynamics"), (2, "a b c"), (3, "水の沸点は摂氏百度である"), (4, "水"), (5, "one two three four five six seven")]
    docs = [(1, "Photosynthesis, thermodynamics!"), (2, "photosynthesis and thermodynamics"), (3, "a b c"), (4, "彼は「水の沸点は摂氏百度である」と言った"), (5, "水の融点は華氏九十度である"), (6, "0 one two three four five six seven 8"), (7, "one two three four five six")]
    assert leaks(spark, docs, items) == {(1, 1), (4, 3), (6, 5)}
    assert dc.words("Ab水c ทด d") == ["ab", "水", "c", "ท", "ด", "d"] and dc.words("straße É") == ["strasse", "é"]


def test_long_items_are_verified_without_walks(spark):
    r = random.Random(1)
    item = draw(900)
    index = dc.Index([(1, " ".join(item))], 0.2, 5, 0.99)
    assert not index.classes[0].walks and index.classes[0].recall == 1
    docs = [(k, " ".join([*draw(k), *edited(r, item), *draw(50)])) for k in (0, 3, 200, 900)] + [(5, " ".join(draw(3000)))]
    assert leaks(spark, docs, [(1, " ".join(item))]) == {(0, 1), (3, 1), (200, 1), (900, 1)}


def test_blocks_hold_repeated_rows_apart(spark):
    items = [(i % 7, "one passage that everybody has in the benchmark again and again and again") for i in range(300)]
    bench = spark.createDataFrame([*items, (99, "another passage that only one row has in all of this benchmark")], "item_id long, text string")
    sizes = [len(b) for b in dc._blocks(bench, 30, 10**9)]
    assert sum(sizes) == 301 and max(sizes) <= 60 and len(sizes) == 11
    assert max(len(b) for b in dc._blocks(bench, 10**9, 2000)) <= 60
    docs = [(1, items[0][1]), (2, "nothing of it")]
    assert leaks(spark, docs, [(99, "x y"), *items], block_items=100) == {(1, i) for i in range(7)}


def test_recalls(spark):
    bench = spark.createDataFrame([(i, " ".join(draw(12 + i % 50))) for i in range(80)] + [(100, "six words of a short item"), (None, None)], "item_id long, text string")
    rows = dc.recalls(bench).collect()
    assert sum(r["items"] for r in rows) == 81 and all(r.recall >= 0.99 for r in rows) and any(r.rounds >= 4 for r in rows)
    assert dc.recalls(bench.where("false")).count() == 0


def test_repeated_passages_in_one_text(made):
    """A passage very often in one text is one row, and verified a bounded number of times."""
    items, index = made
    body = [index.symbol[w] for w in items[5][1].split()]
    before = index.verified
    assert [(d, i, e) for d, i, e, *_ in index.leaks([(1, body * 500), (2, []), (3, body)])] == [(1, 5, 0), (3, 5, 0)]
    assert index.verified - before < 2000


def test_ranges():
    assert dc.ranges(np.array([5, 0, 3]), np.array([7, 4, 6])).tolist() == [0, 1, 2, 3, 4, 5, 6]
    assert dc.ranges(np.array([2, 9]), np.array([4, 10])).tolist() == [2, 3, 9]
