import random
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rillflow.llm import packing, token_counts, tokens

PLAIN = Tokenizer.from_file(tokens.default_tokenizer())


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def ids(text):
    raw = tokens.word_tokenizer(tokens.default_tokenizer()).packed(text.encode())
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


PIECES = st.sampled_from([*"abcDEF.,;'!? \n\t", "İ", "ı", "ς", "Σ", "é", "é", " ", "\x1c", "\x1f", "\x85", "\u200b", "漢字", "9", "don't", "<|endoftext|>", "क़", "🙂", "a" * 80])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join) | st.text(max_size=40))
def test_words_give_the_tokenizers_ids(text):
    assert ids(text) == plain(text)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 7)
    t = tokens.WordTokenizer(tokens.default_tokenizer())
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join(rng.choice("ab cd. ef! gh ij kl mn op, qr".split()) for _ in range(rng.randint(0, 12)))
        assert len(t.packed(text.encode())) == 4 * len(plain(text))
    assert len(t._ids) <= 7 + 24 and len(t._old) <= 7 + 24


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 20))
def test_first_fit_decreasing(sizes, seed):
    where = packing.first_fit_decreasing(sizes, 100)
    want, room = {}, []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        room[b:b] = [100] if b == len(room) else []
        room[b] -= sizes[i]
        want[i] = b
    assert where == [want[i] for i in range(len(sizes))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=60), st.integers(1, 30))
def test_plan_cuts_each_document_once(lengths, least):
    pieces, room = packing.plan(lengths, 128, least), 128
    fill = {}
    for d, n in enumerate(lengths):
        mine = sorted(p[1:3] for p in pieces if p[0] == d)
        assert [s for s, _ in mine] == [sum(x for _, x in mine[:i]) for i in range(len(mine))] and sum(x for _, x in mine) == n
    for _, _, n, seq, off in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert fill.get(seq, 0) == off and n >= 1
        fill[seq] = off + n
    assert all(x <= room for x in fill.values()) and sorted(fill) == list(range(len(fill)))


def test_pack(spark):
    rng = random.Random(2)
    long = " ".join(rng.choice(["word", "other", "thing."]) for _ in range(30_000))
    texts = [None, "", " ", "short", "short", long] + [" ".join(["x"] * rng.randint(1, 3000)) for _ in range(40)]
    rows = [(i if i != 3 else None, t, "a", 1) for i, t in enumerate(texts)] + [(7, texts[7], "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, start int")
    out = packing.pack(df, group_tokens=20_000).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in rows:
        want = [*plain(t), 1]
        for r in by[i]:
            assert r.doc_tokens == len(want) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *want[r.start : r.start + r.length]))
        assert sum(r.length for r in by[i]) == len(want) * (2 if i == 7 else 1)
    assert packing.pack(df.where("false")).count() == 0


def test_token_counts(spark):
    texts = [None, "", "a b c", "a b c", "hello there general", "x " * 5000, "one"]
    df = spark.createDataFrame([(t, 5) for t in texts], "text string, n_docs int")
    lengths = [len(plain(t)) for t in texts]
    rows = {r.n_tokens: r for r in token_counts.token_counts(df).collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r.n_docs == lengths.count(n) and r.docs_at_least == sum(x >= n for x in lengths) and r.docs_longer == sum(x > n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n) and r.truncated_total == sum(min(x, n) for x in lengths)
        assert r.share_at_most == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    made = token_counts.token_counts(df)
    assert token_counts.truncated_total(made, 100).first()[0] == sum(min(x, 100) for x in lengths)
    assert token_counts.quantile(made, 0.5).first()[0] == sorted(lengths)[3]
    assert token_counts.token_counts(df.where("false")).count() == 0
