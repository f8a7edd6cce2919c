import random
import zlib

import numpy as np

from rillflow.llm import language_id as li

SYLLABLES = {"aa": "ba be bi bo bu ka ke".split(), "bb": "strö gra schne pfü ze".split(), "cc": "eau ou ien è ç".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def made(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, text(rng, lang, rng.randint(3, 60)), lang))
    return rows


def test_symbols_and_codes():
    assert li.symbols("Ab, 9 c!").tolist() == [1, 2, 0, 3] and len(li.symbols("12 !?")) == 0 and len(li.symbols("")) == 0
    assert len(set(li.symbols("aéßzж").tolist())) == 5
    docs = [li.symbols("ab"), li.symbols("c")]
    code, firsts = li.codes(docs)
    grams = [[(c >> (6 * k)) & 63 for k in (3, 2, 1, 0)] for c in code.tolist()]
    assert grams == [[0, 0, 0, 1], [0, 0, 1, 2], [0, 1, 2, 0], [0, 0, 0, 3], [0, 0, 3, 0]] and firsts.tolist() == [0, 3]
    found, at = li.Distinct()(code)
    assert found[at].tolist() == code.tolist() and sorted(found) == found.tolist()


def kneser_ney(counts, discounts):
    """Plain interpolated probabilities over tuples."""
    orders = [counts]
    for _ in range(3):
        lower = {}
        for g in orders[0]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        orders.insert(0, lower)

    def p(g):
        if not g:
            return 1 / 64
        c, d, ctx = orders[len(g) - 1], discounts[len(g) - 1], g[:-1]
        mine = {x: n for x, n in c.items() if x[:-1] == ctx}
        if not mine:
            return p(g[1:])
        total = sum(mine.values())
        return max(c.get(g, 0) - d, 0) / total + d * len(mine) / total * p(g[1:])

    return p, orders


def test_model_against_plain_kneser_ney():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 5, 400) | rng.integers(0, 5, 400) << 6 | rng.integers(0, 5, 400) << 12 | rng.integers(0, 5, 400) << 18
    grams, n = np.unique(code, return_counts=True)
    model = li.Model(grams, n, 1)
    split = lambda c: tuple(int(c) >> s & 63 for s in (18, 12, 6, 0))
    counts = {split(g): int(x) for g, x in zip(grams, n, strict=True)}
    _, orders = kneser_ney(counts, [0] * 4)
    discounts = []
    for o in orders:
        n1, n2 = (sum(v == k for v in o.values()) for k in (1, 2))
        discounts.append(min(0.9, max(0.1, n1 / max(1, n1 + 2 * n2))))
    p, _ = kneser_ney(counts, discounts)
    asked = np.concatenate([grams[:50], rng.integers(0, 1 << 24, 50), grams[:20] ^ 1, grams[:20] ^ (7 << 18)])
    assert np.allclose(model.scores(asked), [np.log(p(split(c))) for c in asked], atol=1e-4)
    assert abs(sum(np.exp(model.scores((grams[0] & ~63) | np.arange(64)))) - 1) < 1e-3


def test_held_out_accuracy_and_folds(spark):
    rows = made()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in li.identify(df).collect()}
    truth = {i: lang for i, _, lang in rows}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values()) and not any(r.rejected for r in got.values())
    # held-out labels are never learned from
    lied = spark.createDataFrame([(i, t, "zz" if i in held else lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in li.identify(lied).collect()} == {i: r.lang_pred for i, r in got.items()}


def test_odd_rows(spark):
    rows = [*made(200), (1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "aa"), (None, "ba be bi bo bu", "aa"), (1003, "ba be bi bo", None), (1004, "qxzjw vqxj " * 9, "aa"), (1005, "strö gra " * 50_000, None), (5, "eau ou", "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in li.identify(df).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (1000, 1001, 1002))
    assert got[None].held_out and got[None].lang_pred == "aa" and got[1003].lang_pred == "aa" and got[1005].lang_pred == "bb" and got[1004].lang_pred in SYLLABLES
    assert li.identify(df).count() == len(rows) and li.identify(df.where("false")).count() == 0
    none = spark.createDataFrame([(1, "abc", None)], df.schema)
    assert [r.lang_pred for r in li.identify(none).collect()] == ["und"]


def test_entries_are_bounded_by_leaving_out_rare_grams(spark):
    df = spark.createDataFrame(made(200), "doc_id long, text string, lang string")
    full, small = li.train(df), li.train(df, model_entries=400)
    assert sum(len(m.grams[3]) for m in small.values()) <= 400 < sum(len(m.grams[3]) for m in full.values())
    scored = li.score(df, small, "text", "lang").collect()
    assert np.mean([r.lang == r.lang_pred for r in scored]) > 0.9


def test_all_counts_make_the_lower_orders(spark):
    df = spark.createDataFrame(made(200), "doc_id long, text string, lang string")
    full, small = li.train(df), li.train(df, model_entries=400)
    for x, m in full.items():
        for k in range(3):
            assert np.array_equal(m.grams[k], small[x].grams[k]) and np.array_equal(m.logp[k], small[x].logp[k])
        kept = np.isin(m.grams[3], small[x].grams[3])
        assert np.array_equal(m.logp[3][kept], small[x].logp[3])


def test_several_passes_give_the_same_rows(spark, monkeypatch):
    rows = [*made(150), (1000, None, "aa"), (1001, "12 34", "bb"), (None, "ba be", "aa"), (7, "eau ou", "cc"), (7, "eau ou", "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = sorted(li.identify(df).collect(), key=str)
    assert len(want) == len(rows)
    for entries, chunk in ((1, 5), (700, 1_000_000)):
        monkeypatch.setattr(li, "BROADCAST_ENTRIES", entries)
        monkeypatch.setattr(li, "CHUNK", chunk)
        assert sorted(li.identify(df).collect(), key=str) == want
    assert li.shards({"a": 3, "b": 3, "c": 9, "d": 1}, 6) == [["a", "b"], ["c"], ["d"]]
