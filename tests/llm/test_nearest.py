import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, k):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8:
            known.setdefault((i, tuple(np.float32(v).tolist())), None)
    ids, x = [i for i, _ in known], np.array([v for _, v in known], float)
    out = {}
    for q, v in zip(ids, x, strict=True):
        if q % 20 == 0:
            s = x @ v
            out[q] = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != q)[:k]
    return out


def rows_(n, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, 8))
    x = (centers[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, 8))) * rng.uniform(0.5, 2, (n, 1))
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    return rows + [(n + i, rows[0][1]) for i in range(copies)]


def test_recall_and_scores(spark):
    rows = rows_(1500, copies=800)  # a third of the rows is one vector
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {}
    for r in nearest.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, 20)
    assert set(got) == set(want)
    hit = total = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and q not in [i for _, i, _ in mine]
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({i for _, i, _ in mine} & {i for _, i in near})
        total += len(near)
    assert hit / total >= 0.9
    x = {i: np.array(v) for i, v in rows}
    assert all(abs(s - x[q] @ x[i]) < 1e-9 for q in list(got)[:20] for _, i, s in got[q])


def test_odd_rows(spark):
    rows = rows_(45)
    odd = [(100, None), (None, rows[3][1]), (120, [0.0] * 8), (140, [1.0] * 7 + [None]), (160, [float("nan")] * 8), (180, [float("inf")] + [1.0] * 7), (200, [1.0] * 5), (20, rows[20][1]), (220, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], SCHEMA)
    got = {}
    for r in nearest.search(df, F.col("vec_id") % 20 == 0, k=50).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = brute(rows + odd, 50)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert all(len(v) == 44 for v in got.values())


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny(spark, n):
    df = spark.createDataFrame([(i, [1.0, float(i)], 1) for i in range(n)], SCHEMA)
    assert nearest.search(df, F.col("vec_id") % 20 == 0).count() == max(0, n - 1)


def test_tree_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(900, 5))
    tree = nearest.Tree(x, 40)
    order = tree.visits(x[0], 10**6)
    assert sorted(order) == list(range(len(tree.leaf))) and len(tree.visits(x[0], 7)) == 7
    leaf = tree.assign(x)
    assert set(leaf.tolist()) <= set(order) and np.mean([leaf[i] == tree.visits(x[i], 1)[0] for i in range(100)]) > 0.7
