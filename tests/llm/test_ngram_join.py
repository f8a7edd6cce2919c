import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import ngram_join as nj
from rillflow.llm.components import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in (text or "").translate(UPPER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]


def grams(text, n=3):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n=3, percent=90):
    sets = {i: grams(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        i, u = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if u and 100 * i >= percent * u:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 250))] for _ in range(40)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    for k in range(160):
        w = list(rng.choice(base[:8] if k % 2 else base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if k % 3 == 0:
            w[len(w) // 2 : len(w) // 2] = shared
        rows.append((k, rng.choice([" ", "\n", "\t "]).join(w).upper() if k % 7 == 0 else " ".join(w)))
    return rows


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.sampled_from([80, 90, 95]), st.randoms(use_true_random=False))
def test_linked_sets_share_a_key(size, percent, rng):
    a = np.unique(np.array([rng.getrandbits(64) for _ in range(size)], np.uint64))
    most = (100 - percent) * len(a) // 100
    keep = len(a) - rng.randint(0, most)
    b = list(rng.sample(a.tolist(), keep))
    while 100 * keep >= percent * (len(a) + len(b) + 1 - keep) and rng.random() < 0.9:
        b.append(rng.getrandbits(64))
    b = np.unique(np.array(b, np.uint64))
    i = len(np.intersect1d(a, b))
    if 100 * i >= percent * (len(a) + len(b) - i) and a.tolist() != b.tolist():
        assert set(nj.part_keys(a, percent)) & set(nj.part_keys(b, percent))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=20), min_size=1, max_size=25), st.integers(0, 24))
def test_linked_against_plain_counts(sets, cut):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    both = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    got = {(int(x), int(y)) for a, b in nj.linked(arrays, None, 80) for x, y in zip(a, b, strict=True) if x != y}
    assert got == {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and both(a, b)}
    if 0 < cut < len(sets):
        got = {(int(x), int(y)) for a, b in nj.linked(arrays[:cut], arrays[cut:], 80) for x, y in zip(a, b, strict=True)}
        assert got == {(i, j) for i, a in enumerate(sets[:cut]) for j, b in enumerate(sets[cut:]) if both(a, b)}


@pytest.mark.parametrize("block, leaders, rows_sent", [(4096, 64, 250_000), (6, 2, 250_000), (6, 2, 0)])
def test_components_against_brute_force(spark, monkeypatch, block, leaders, rows_sent):
    monkeypatch.setattr(nj, "BLOCK_DOCS", block)
    monkeypatch.setattr(nj, "LEADERS", leaders)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.join_components(df, broadcast_rows=rows_sent, broadcast_keys=rows_sent).collect()}
    assert got == brute(rows)


def test_other_parameters(spark):
    rows = corpus(4)[:80]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.join_components(df, 5, 80).collect()} == brute(rows, 5, 80)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(40_000))
    rows = [(9, None), (8, ""), (7, " \n\t"), (6, "one"), (5, "ONE"), (4, "one two"), (3, "one two three"), (2, "One Two THREE"), (2, "one two three"), (1, "É é"), (0, "é é"), (20, long), (21, long + " y"), (22, "a b c"), (23, "a b c"), (None, "one two"), (None, "none other like"), (30, "twice"), (30, "other thing")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, class string")
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in nj.join_components(df).collect()), key=str)
    want = [(9, 0, 9), (8, 0, 8), (7, 0, 7), (6, 1, 5), (5, 1, 5), (4, 1, 4), (3, 1, 2), (2, 1, 2), (2, 1, 2), (1, 1, 1), (0, 1, 0), (20, 39_998, 20), (21, 39_999, 20), (22, 1, 22), (23, 1, 23), (-1, 1, 4), (-1, 1, None), (30, 1, 30), (30, 1, 30)]
    assert got == sorted(want, key=str)
    assert nj.join_components(df.where("false")).count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=60))
def test_components(spark, links):
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    alone = {x for x in root if all(a == b for a, b in links if x in (a, b))}
    assert got == {x: r for x, r in root.items() if x not in alone}


def test_long_chain(spark):
    got = components(spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"))
    assert {r.label for r in got.collect()} == {0} and got.count() == 301


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=25), min_size=1, max_size=25), st.sampled_from([60, 80, 85]))
def test_linked_sets_share_a_rare_key(sets, percent):
    grams = np.array([g for s in sets for g in s], np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, times = np.unique(grams, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    at, keys = nj.rarest_keys(doc[shared], grams[shared], times[which][shared], np.array([len(s) for s in sets]), percent)
    of = [set(keys[at == i].tolist()) for i in range(len(sets))]
    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            assert of[i] & of[j]
