"""Alphabets from the training text, languages cut into pieces, and rejection by a bound measured on unseen documents."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from test_language import SYLLABLES, made, text

from rillflow.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string"


def test_letters_keep_their_identity(spark):
    """Languages of one script, told apart by letters that are equal in any small residue."""
    rng = random.Random(2)
    words = {"xx": ["かき", "くけ", "さし"], "yy": ["たち", "つて", "なに"], "uu": ["жар", "зло", "ива"], "vv": ["дым", "дни", "еда"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randint(2, 9))), x) for i, x in enumerate(rng.choice(list(words)) for _ in range(200))]
    got = {r.doc_id: r.lang_pred for r in li.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == x for i, _, x in rows)


def test_wide_alphabets_need_more_bits():
    small, large = li.Alphabet(np.arange(1, 40)), li.Alphabet(np.arange(0x4E00, 0x4E00 + 3000))
    assert small.bits == 6 and large.bits == 12 and large.rank[0x4E00] == 1 and large.rank[5] == 3001
    docs = [li.symbols("一丁七"), li.symbols("丁")]
    code, firsts = li.codes([large.rank[d] for d in docs], 12)
    wide = np.array([(0x4E00 << 16) | 0x4E01], np.int64)
    assert firsts.tolist() == [0, 4] and code[1] == large.packed(wide)[0] == 1 << 12 | 2
    found, at = li.Distinct()(code, 12)
    assert found[at].tolist() == code.tolist()
    assert len(li.symbols("\U00020000\U00020001")) == 2  # beyond the first plane


def test_pieces_of_a_language_give_the_same_rows(spark, monkeypatch):
    rows = [*made(120), (1000, None, "aa"), (1001, "12 34", "bb"), (None, "ba be", "aa"), (7, "eau ou", "cc"), (7, "eau ou", "cc"), (1002, "жж", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(li.identify(df).collect(), key=str)
    monkeypatch.setattr(li, "LANGUAGE_ENTRIES", 150)
    assert sorted(li.identify(df).collect(), key=str) == want


def test_equal_entropies_go_to_the_first_language(spark):
    rows = [(i, "ba be bi bo", x) for x in ("zz", "aa") for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    got = li.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.lang_pred for r in got} == {"aa"} and all(0.3 < r.score < 0.7 for r in got)


def noise(rng, n):
    return " ".join("".join(rng.choice("qxjwvyzkq") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_rejects_what_is_like_no_language_and_keeps_clean_texts(spark):
    rows = made(1500, 4)
    rng = random.Random(1)
    short = [(5000 + i, text(rng, x, k), x) for i, (x, k) in enumerate((x, k) for x in SYLLABLES for k in (1, 2, 3, 5) for _ in range(10))]
    junk = [(9000 + i, noise(rng, n), None) for i, n in enumerate([12, 20, 50, 400] * 5)]
    junk += [(9100, "это совсем другой язык и другие буквы", None), (9101, "这是另一种语言的文字和句子", None), (9102, "x" * 5000, None)]
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows + short + junk, SCHEMA)).collect()}
    assert all(got[i].rejected for i, _, _ in junk)
    clean = [got[i].rejected for i, _, _ in rows]
    assert np.mean(clean) <= 0.005 and np.mean([got[i].rejected for i, _, _ in short]) <= 0.05
    # scores are shares of right answers among unseen documents: all right here
    assert np.mean([r.score for i, r in got.items() if i < 1500]) > 0.97


def test_labelled_junk_doesnt_move_the_bound(spark):
    """A text of random letters with a language's label is learned from, but not by the models that score it."""
    rng = random.Random(5)
    rows = made(800, 6)
    letters = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    junk = [(3000 + i, " ".join(letters() for _ in range(40)), "aa") for i in range(3)]
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows + junk, SCHEMA)).collect()}
    assert all(got[i].rejected for i, _, _ in junk) and np.mean([got[i].rejected for i, _, _ in rows]) <= 0.01


def test_bound_is_the_rank_of_unseen_documents(spark):
    df = spark.createDataFrame([("a", "a", 1.0 + i / 1000, 0.5, 99) for i in range(1000)], "lang string, lang_pred string, entropy double, lead double, n_symbols long")
    fit = li.Calibration(df, 0.01)
    assert fit.n == 1000 and df.where(fit.passed() > fit.bound).count() in (8, 9, 10)
    assert li.Calibration(df.where("false"), 0.01).bound == float("inf")
    # ten that come after a gap are left out of the bound, so they and the largest of the others pass it
    far = df.withColumn("entropy", F.when(F.col("entropy") < 1.01, 9.0).otherwise(F.col("entropy")))
    fit = li.Calibration(far, 0.01)
    assert far.where(fit.passed() > fit.bound).where("entropy = 9").count() == 10
    assert li.Calibration(df.limit(20), 0.01).bound >= 2.3
