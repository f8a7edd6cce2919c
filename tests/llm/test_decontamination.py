import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import decontamination as dc

WORDS = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r", "st")]


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def distance(pattern, text):
    """Least edit distance of the pattern to any stretch."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[:], i
        for j, t in enumerate(text, 1):
            row[j] = min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1)
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=70), st.lists(st.integers(0, 4), max_size=90))
def test_least_edits(pattern, text):
    masks = {}
    for i, s in enumerate(pattern):
        masks[s] = masks.get(s, 0) | 1 << i
    best, at = dc.least_edits(masks, len(pattern), text)
    assert best == distance(pattern, text) == distance(pattern, text[:at])


@pytest.fixture(scope="module")
def made():
    rng = random.Random(5)
    items = [(i, " ".join(passage(rng, rng.randint(12, 60)))) for i in range(60)]
    items += [(100, items[0][1]), (101, None), (102, ""), (103, "too short here"), (None, " ".join(passage(rng, 20))), (105, "six words of a short item")]
    docs, want = [], {}
    for d in range(160):
        body = passage(rng, rng.randint(0, 400))
        if d % 2:
            item = rng.choice(items[:60])
            w = item[1].split()
            for _ in range(int(0.2 * len(w) * rng.random())):
                w[rng.randrange(len(w))] = "QQQ"
            at = rng.randint(0, len(body))
            body[at:at] = w
            want[d] = item[0]
        text = " ".join(body)
        docs.append((d, text.upper() if d % 3 == 0 else text.replace(" ", "!!\n") if d % 5 == 0 else text))
    return items, docs, want


def test_leaks_against_brute_force(spark, made):
    items, docs, want = made
    extra = [(900, None), (901, ""), (902, items[1][1]), (902, items[1][1]), (None, items[2][1]), (903, "x " * 20_000 + items[3][1]), (904, "six words of a short item"), (905, "six words of a long item")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs + extra], "doc_id long, text string, edits int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.leaks(df, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    brute = set()
    for d, t in docs + extra:
        w = dc.words(t)
        for i, x in items:
            p = dc.words(x)
            if len(p) >= 5 and len(w) < 5000 and distance(p, w) <= dc.allowed_edits(len(p), 0.2):
                brute.add((d, i))
    assert found - {(903, 3)} <= brute and (903, 3) in found
    assert len(brute - found) <= 0.02 * len(brute)  # recall
    exact = {(d, i) for d, i in want.items()}
    assert exact <= brute and len(exact & found) >= 0.98 * len(exact) and (902, 1) in found and (None, 2) in found
    assert (904, 105) in found and (905, 105) not in found and not any(d in (900, 901) for d, _ in found)
    assert sum(r.doc_id == 902 and r.item_id == 1 for r in got) == 2 and all(r.edits == 0 for r in got if r.doc_id == 902)
    clean = {d for d, _ in docs if d % 2 == 0}
    assert not clean & {d for d, _ in found}
    # in several blocks of items
    assert {(r.doc_id, r.item_id) for r in dc.leaks(df, bench, block_items=20).collect()} >= {x for x in found if x[0] == 902}
    left = dc.without_leaks(df, dc.leaks(df, bench))
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs + extra} - {d for d, _ in found}


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.leaks(docs, bench).count() == 0
    assert dc.leaks(docs.where("false"), spark.createDataFrame([(1, "one two three four five six")], bench.schema)).count() == 0
