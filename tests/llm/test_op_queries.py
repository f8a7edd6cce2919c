"""Each query of the subpackage over the smallest whole tables: against its SQL, or what its contract says."""

import os
import struct
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from rillflow.llm import queries as q
from rillflow.llm import tokens

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return {i: (t, lang) for i, t, lang in duck.sql("SELECT doc_id, text, lang FROM documents").fetchall()}


@pytest.mark.parametrize("name", q.ORACLE_SQL)
def test_against_sql(spark, duck, name):
    out, want = q.QUERIES[name](spark, FOLDER), duck.sql(q.ORACLE_SQL[name])
    assert sorted(out.columns) == sorted(want.columns)
    order = sorted(out.columns)
    assert sorted(tuple(str(r[c]) for c in order) for r in out.collect()) == sorted(tuple(str(r[want.columns.index(c)]) for c in order) for r in want.fetchall())


def test_packing(spark, documents):
    """Every id in one piece, sequences without gaps, and little padding."""
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    by_doc, by_sequence = {}, {}
    for r in q.op2_packing(spark, FOLDER).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(documents)
    for i, rows in by_doc.items():
        ids, at = [*plain.encode(documents[i][0] or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    held = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        held += at
    assert held / (2048 * len(by_sequence)) > 0.97


def test_nearest_recall(spark, duck):
    rows = duck.sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in q.op8_nearest(spark, FOLDER).collect():
        got.setdefault(r.query_id, []).append(r)
    asked = [i for i in ids.tolist() if i % 20 == 0]
    assert set(got) == set(asked)
    hit = 0
    for i in asked:
        s = x @ x[np.flatnonzero(ids == i)[0]]
        order = [j for j in np.lexsort((ids, -s)).tolist() if ids[j] != i][:20]
        near = sorted(got[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in near] == list(range(1, len(order) + 1)) and all(r.compared <= len(ids) for r in near)
        assert [(-r.score, r.vec_id) for r in near] == sorted((-r.score, r.vec_id) for r in near)
        assert all(abs(r.score - s[np.flatnonzero(ids == r.vec_id)[0]]) < 1e-9 for r in near)
        hit += len({r.vec_id for r in near} & set(ids[order].tolist())) / len(order)
    assert hit / len(asked) >= 0.9


def test_language_id(spark, documents):
    got = q.op9_language_id(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    known = [r for r in got if r.held_out and r.lang_pred != "und" and documents[r.doc_id][1]]
    assert np.mean([r.lang_pred == documents[r.doc_id][1] for r in known]) > 0.95
    assert np.mean([r.rejected for r in known]) < 0.05


def test_decontamination_finds_exact_passages(spark, duck, documents):
    """What a plain search for the items' words finds is found, and nothing without a near passage is."""
    from test_decontamination import distance

    from rillflow.llm import decontamination as dc

    items = dict(duck.sql("SELECT item_id, text FROM benchmark").fetchall())
    found = {(r.doc_id, r.item_id): r for r in q.op1_decontamination(spark, FOLDER).collect()}
    spaced = {i: f" {' '.join(dc.words(t))} " for i, (t, _) in documents.items()}
    exact = {(d, i) for i, x in items.items() for d, t in spaced.items() if f" {' '.join(dc.words(x))} " in t}
    assert exact <= set(found) and all(found[k].edits == 0 for k in exact)
    for (d, i), r in list(found.items())[:20]:
        words, item = dc.words(documents[d][0]), dc.words(items[i])
        near = words[max(0, r.last_word - 2 * len(item)) : r.last_word + 2 * len(item)]
        assert distance(item, near) <= dc.allowed_edits(len(item), 0.2)


def test_token_counts(spark, documents):
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    lengths = [len(plain.encode(t or "", add_special_tokens=False).ids) for t, _ in documents.values()]
    rows = q.op6_token_counts(spark, FOLDER).collect()
    assert {r.n_tokens: r.n_docs for r in rows} == {n: lengths.count(n) for n in set(lengths)}
    assert all(r.truncated_total == sum(min(x, r.n_tokens) for x in lengths) for r in rows)
