"""The pipeline against a brute-force version, and each stage on odd rows."""

import random

import corpus_pipeline as cp
import pytest
from test_ngram_join import brute

from rillflow.llm import decontamination as dc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_(rng):
    syllables = {"en": "th er on an re he in ed nd ha".split(), "fr": "eau ou ien è ç ai que".split()}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word("en") for _ in range(25))) for i in range(5)]
    texts = []
    for _ in range(150):
        lang = rng.choice(["en", "fr"])
        texts.append((" ".join(word(lang) for _ in range(rng.randint(5, 300))), lang))
    for k in range(30):
        t, lang = texts[k]
        w = t.split()
        if k % 2:
            w[len(w) // 2] = "changed"
        texts.append((" ".join(w), lang))
    for k in range(10):
        texts.append((texts[40 + k][0] + " " + items[k % 5][1], texts[40 + k][1]))
    texts += [("", "en"), ("123 456", "en"), (None, "en")]
    rng.shuffle(texts)
    return [(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts)], items


def test_against_brute_force(spark, tmp_path):
    rows, items = rows_(random.Random(8))
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    parts = brute([r[:2] for r in left])
    left = [r for r in left if parts[r[0]][1] == r[0]]
    leaks = {r[0] for r in left for _, x in items if " ".join(dc.words(x)) in " ".join(dc.words(r[1]))}
    assert leaks
    left = {r[0] for r in left} - leaks
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.schema == df.schema, name
        docs = cp.table(docs, "t")
    assert {r.doc_id for r in docs.collect()} == left
    pieces = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == left
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


@pytest.mark.parametrize("stage", range(4))
def test_odd_rows(spark, tmp_path, stage):
    rows, items = rows_(random.Random(9))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own = "ther anon heed inre thhe ndth hahaon anre thtiin onhean reinth edhand"
    odd = [(None, own, None, None, None), (None, None, None, None, None), (0, own + " onin thandre heedha anthre on reheon", "en", "s", 1), (1, rows[1][1], *rows[1][2:])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], SCHEMA + ", doc_id_ string, uid int")
    out = cp.STAGES[stage][1](spark, df, str(tmp_path))
    if stage < 3:
        assert out.columns == df.columns
        kept = out.collect()
        assert any(r.doc_id is None and r.text == own for r in kept)
        assert not stage == 0 or not any(r.text is None for r in kept)
        assert not stage == 1 or sum(r.doc_id == 1 and r.text == rows[1][1] for r in kept) <= 1
    assert cp.STAGES[stage][1](spark, df.where("false"), str(tmp_path)).count() == 0


def test_near_duplicates_at_five_words_and_four_fifths(spark, tmp_path):
    """One word of 52 and two of 100 changed: under 0.9 of three words, over 0.8 of five."""
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randrange(10_000)}" for _ in range(n)]
    a, b, c = text(52), text(100), text(40)
    near = [a, [*a[:20], "x", *a[21:]], b, [*b[:30], "x", *b[31:60], "y", *b[61:]], c, [*c[:20], "x", *c[21:]]]
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in enumerate(near)]
    kept = {r.doc_id for r in cp.near_duplicate_stage(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()}
    parts = brute([r[:2] for r in rows], 5, 80)
    assert kept == {i for i, (_, least) in parts.items() if i == least} == {0, 2, 4, 5}
    assert {i for i, (_, least) in brute([r[:2] for r in rows]).items() if i == least} == {0, 1, 2, 3, 4, 5}
