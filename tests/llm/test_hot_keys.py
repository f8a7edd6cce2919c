"""Groups that hold a large share of all rows: joins, products, conversations and packing groups."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillflow.llm import chat, ngram_join, packing, store
from rillflow.llm.joins import joined, without


def components_of(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    out = []
    for x in range(n):
        while root[x] != x:
            x = root[x]
        out.append(x)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=8), min_size=1, max_size=22), st.integers(0, 22), st.integers(1, 4), st.sampled_from([0, 2, 64]))
def test_spanning_links_join_what_all_links_join(sets, first, leaders, sparse):
    arrays, first = [np.array(sorted(s), np.uint64) for s in sets], max(1, min(first, len(sets)))
    old = ngram_join.LEADERS, ngram_join.SPARSE, ngram_join.TILE
    ngram_join.LEADERS, ngram_join.SPARSE, ngram_join.TILE = leaders, sparse, 3
    try:
        got = [(int(x), int(y)) for a, b in ngram_join.spanning(arrays, first, 60) for x, y in zip(a, b, strict=True)]
    finally:
        ngram_join.LEADERS, ngram_join.SPARSE, ngram_join.TILE = old
    link = lambda i, j: 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j])
    apart = lambda i, j: first == len(sets) or (i < first) != (j < first)
    want = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if link(i, j) and apart(i, j)]
    assert all(link(i, j) and apart(i, j) for i, j in got)
    assert components_of(len(sets), got) == components_of(len(sets), want)


def test_a_group_of_near_copies_isnt_multiplied_with_itself(monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) > 0.02], rng.integers(0, 1 << 60, 2).astype(np.uint64)])) for _ in range(1500)]
    rows = []
    overlaps = ngram_join.Product.overlaps
    monkeypatch.setattr(ngram_join.Product, "overlaps", lambda self, x: rows.append(len(x)) or overlaps(self, x))
    assert len(list(ngram_join.spanning(sets, len(sets), 80))) == 1499 and sum(rows) < 70


def test_joined(spark):
    left = spark.createDataFrame([(1 if i % 3 == 0 else i if i % 3 == 1 else None, i) for i in range(300)], "k long, i long")
    right = spark.createDataFrame([(1, "one"), (4, "four"), (9999, "none")], "k long, v string")
    want = sorted(left.join(right, "k", "left").collect(), key=str)
    counts = left.groupBy("k").agg(F.count("*").alias("c"))
    for share in (1, 3, 100, 1000):
        assert sorted(joined(left, right, "k", counts, share).collect(), key=str) == want
    text = joined(left, right, "k", counts, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in text
    assert joined(left.where("false"), right, "k", counts.where("false")).count() == 0
    assert without(left.withColumnRenamed("k", "doc_id"), spark.createDataFrame([(1,), (None,)], "doc_id long"), 0).count() == 300 - 100 - 100 - 1


def test_one_conversation_of_many_turns_is_many_tasks_work(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(1, i - 20, rng.choice(["user", "assistant", "tool"]), f"turn {i} </s>") for i in range(300)] + [(1, None, "user", "first"), (2, 2**62, "user", "far"), (2, -(2**62), "assistant", "low"), (3, 0, "user", "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = sorted(chat.digests(chat.format_chats(df)).collect())
    monkeypatch.setattr(chat, "CHUNK_TURNS", 16)
    parts = chat.format_chats(df).cache()
    assert sorted(chat.digests(parts).collect()) == want and {r.conv_id: r.n_turns for r in want} == {1: 301, 2: 2, 3: 1}
    assert parts.where("conv_id = 1").count() > 18 and parts.where("part <= -4611686018427387904 or part >= 4611686018427387904").count() == 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 130), max_size=80), st.integers(1, 20))
def test_plans_hold_every_id_once_with_little_padding(lengths, least):
    bins, docs = {}, {}
    for d, start, n, seq, offset in packing.plan(lengths, 50, least):
        bins.setdefault(seq, []).append((offset, n))
        docs.setdefault(d, []).append((start, n))
    for some, total in [*((v, None) for v in bins.values()), *((v, lengths[d]) for d, v in docs.items())]:
        at = 0
        for start, n in sorted(some):
            assert start == at and n > 0
            at += n
        assert at <= 50 if total is None else at == total
    assert set(docs) == set(range(len(lengths)))
    # cutting stops only where what is free can't take a whole bin more, but for rooms under the least cut
    assert len(bins) <= -(-sum(lengths) // (50 - least)) + 1 if least < 25 else True


def test_groups_are_bounded_by_documents_and_dealt_at_random(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "if(id % 7 = 0, 'some words of a text', null) as text").coalesce(1)
    rows = packing.pack(df, group_docs=100).collect()
    assert sorted({r.doc_id for r in rows}) == list(range(2000)) and sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert len({r.sequence_id for r in rows}) >= 16
    again = packing.pack(df, group_docs=100).collect()
    assert sorted(rows) == sorted(again) != sorted(packing.pack(df, group_docs=100, seed=1).collect())


def test_tables_can_be_cleared(spark):
    frame = store.table(spark.range(3).toDF("x"), "some")
    assert frame.count() == 3
    path = store._written[spark.sparkContext.applicationId][-1].removeprefix("file://")
    import os

    assert os.path.isdir(path)
    store.clear(spark)
    assert not os.path.exists(path) and spark.sparkContext.applicationId not in store._written


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_one_payload_in_very_many_records(spark, broadcast_rows):
    from rillflow.llm import warc

    body = "<p>the same error page everywhere</p>" * 5
    df = spark.createDataFrame([(i, "u", body if i % 2 else f"{i} " * 60) for i in range(100)] + [(500 + i, "u", f"{2 * (i % 20)} " * 60) for i in range(20)], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.plan(df, broadcast_rows=broadcast_rows).collect()}
    assert got == {i: (1 if i > 1 else None) if i % 2 else None for i in range(100)} | {500 + i: 2 * (i % 20) for i in range(20)}
