"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree searched best bin first.

1. Equal vectors are one class. A class keeps its k + 1 smallest ids: a query can't return more of it, as ties go to smaller
   ids, so nothing is lost and no vector is hot.
2. One more component, sqrt(longest**2 - length**2), turns largest inner product into least distance. The tree has about the
   square root of the classes as leaves, and is fitted by k-means on ``leaf_rows`` classes for each leaf (those of the least id
   hashes), together at most ``fit_rows``, which bounds the leaves too; its centroids are all that is broadcast. Every class
   is put into its leaf.
3. A query opens nodes from a priority queue by distance of centroid, and so visits leaves, nearest first. How many is
   calibrated: for ``trial_queries`` queries the true neighbours are found over all rows, and visits widen until
   ``target_recall`` of those lie in visited leaves. A query goes on visiting while the visited leaves hold no k + 1 vectors.
4. Vectors of a leaf are dealt in blocks of bounded size; a task holds one block and streams the queries that visit it, in
   double precision. Each hands on its k + 1 best, which are merged per class that asks. Its queries get those by a join in which
   a class with very many queries is broadcast.

Defined cases: rows whose id or vector is null, or whose vector is all zeros, holds a null or non-finite component, or is not of
the commonest length, take no part; equal rows count once; ties go to the smaller id; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.joins import joined
from rillflow.llm.store import partitions, table

BRANCHES, BLOCK = 16, 4096


class Tree:
    """Nodes as arrays: children[i] are node numbers (none for a leaf), centers[i] the centroids of those children."""

    def __init__(self, x: np.ndarray, leaves: int):
        self.children: list[np.ndarray] = [np.empty(0, np.int64)]
        self.centers: list[np.ndarray] = [np.empty((0, x.shape[1] if x.ndim == 2 else 0))]
        self.leaf: dict[int, int] = {}
        self._split(0, x, leaves, np.random.default_rng(7))
        self.leaf = {node: i for i, node in enumerate(n for n, c in enumerate(self.children) if not len(c))}
        self.sizes = np.zeros(len(self.leaf), np.int64)  # vectors in each leaf, once they are placed

    def _split(self, node: int, x: np.ndarray, leaves: int, rng: np.random.Generator) -> None:
        k = min(BRANCHES, leaves, len(x))
        if k < 2:
            return
        centers = x[rng.choice(len(x), k, replace=False)]
        for _ in range(12):
            of = nearest(x, centers)
            size = np.bincount(of, minlength=len(centers))
            total = np.zeros_like(centers)
            np.add.at(total, of, x)
            centers = total[size > 0] / size[size > 0, None]
        of = nearest(x, centers)
        if len(centers) < 2:
            return
        first = len(self.children)
        self.children[node], self.centers[node] = np.arange(first, first + len(centers)), centers
        for _ in centers:
            self.children.append(np.empty(0, np.int64))
            self.centers.append(centers[:0])
        for i in range(len(centers)):
            mine = x[of == i]
            self._split(first + i, mine, round(leaves * len(mine) / max(1, len(x))), rng)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at, out = [(0, np.arange(len(x)))], np.zeros(len(x), np.int64)
        while at:
            node, rows = at.pop()
            if not len(self.children[node]):
                out[rows] = self.leaf[node]
            elif len(rows):
                of = nearest(x[rows], self.centers[node])
                at += [(int(c), rows[of == i]) for i, c in enumerate(self.children[node])]
        return out

    def visits(self, q: np.ndarray, most: int, least: int = 0) -> list[int]:
        """The leaves that a query visits, best bin first: ``most`` of them, and more while they hold fewer than ``least`` vectors."""
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < most or held < least):
            _, node = heapq.heappop(queue)
            if len(self.children[node]):
                far = ((self.centers[node] - q) ** 2).sum(1)
                for d, c in zip(far.tolist(), self.children[node].tolist(), strict=True):
                    heapq.heappush(queue, (d, c))
            else:
                out.append(self.leaf[node])
                held += int(self.sizes[out[-1]])
        return out


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(1) - 2 * (x @ centers.T)).argmin(1)


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0, longest - (x**2).sum(1)))[:, None]])


def best(scores: np.ndarray, owner: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row of scores (a column per class), its k best ids and their scores; ids are those of class owner[i]."""
    few = min(k, scores.shape[1])
    for row in scores:
        # classes at least as good as the k-th best hold every id that can be among the k best
        least = np.partition(row, -few)[-few]
        mine = np.flatnonzero(row[owner] >= least)
        order = np.lexsort((ids[mine], -row[owner[mine]]))[:k]
        yield ids[mine[order]], row[owner[mine[order]]]


def usable(vector: str) -> Column:
    return F.expr(f"{vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists({vector}, x -> x != 0)")


def search(vectors: DataFrame, is_query: Column, k: int = 20, target_recall: float = 0.97, fit_rows: int = 200_000, leaf_rows: int = 32, trial_queries: int = 200) -> DataFrame:
    """query_id, rank, vec_id, score and compared (vectors that the query met) for every row that ``is_query`` (an expression on vec_id)
    names."""
    spark, schema = vectors.sparkSession, "query_id long, rank int, vec_id long, score double, compared long"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).where("vec_id is not null").where(usable("vector"))
    common = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), F.max(F.expr("aggregate(vector, double(0), (a, x) -> a + double(x) * double(x))")).alias("longest")).orderBy(F.desc("n"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim, longest = common["dim"], float(common["longest"])
    rows = rows.where(F.size("vector") == dim)
    in_class = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.dropDuplicates(["vec_id", "vector"]).withColumn("r", F.row_number().over(in_class)).where(F.col("r") <= k + 1)
    classes = kept.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("rep", F.col("ids")[0])
    asked = rows.where(is_query).select("vector").distinct().withColumn("asked", F.lit(True))
    classes = table(classes.join(asked, "vector", "left").select("rep", "ids", "vector", F.coalesce("asked", F.lit(False)).alias("asked")), "classes")
    n = classes.count()

    hashed, leaves = F.xxhash64("rep"), max(1, min(fit_rows // leaf_rows, round(n**0.5)))
    some = classes.select("vector").orderBy(hashed, "rep").limit(leaves * leaf_rows).toArrow()
    tree = Tree(lifted(matrix(some.column(0), dim), longest), leaves)
    sent = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = sent.value.assign(lifted(matrix(b.column(2), dim), longest)) if b.num_rows else []
            yield pa.record_batch([*b.columns, pa.array(leaf, pa.int64())], names=[*b.schema.names, "leaf"])

    index = table(classes.mapInArrow(place, f"rep long, ids array<long>, vector {kind(classes)}, asked boolean, leaf long"), "index")
    in_leaf = index.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("held")).collect()  # a row a leaf
    for r in in_leaf:
        tree.sizes[r.leaf] = r.held
    sent = spark.sparkContext.broadcast(tree)
    visits = _calibrate(index, tree, dim, k, target_recall, trial_queries)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = np.hstack([matrix(b.column(1), dim), np.zeros((b.num_rows, 1))])
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                leaves = [sent.value.visits(x, visits, k + 1) for x in q[at : at + 256]]
                compared = [int(sent.value.sizes[x].sum()) for x in leaves]
                yield pa.record_batch([*part.columns, pa.array(leaves, pa.list_(pa.int64())), pa.array(compared, pa.int64())], names=["rep", "vector", "leaves", "compared"])

    # each leaf's vectors lie in blocks; a query goes to all blocks of the leaves that it visits
    sizes = spark.createDataFrame([(r.leaf, -(-r.n // BLOCK)) for r in in_leaf], "leaf long, blocks long")
    held = index.join(F.broadcast(sizes), "leaf").select("leaf", F.expr("pmod(xxhash64(rep), blocks)").alias("block"), F.lit(0).alias("kind"), "rep", "ids", "vector", F.lit(None).cast("long").alias("compared"))
    asking = index.where("asked").select("rep", "vector").mapInArrow(go, f"rep long, vector {kind(classes)}, leaves array<long>, compared long")
    asking = asking.select("rep", "vector", "compared", F.explode("leaves").alias("leaf")).join(F.broadcast(sizes), "leaf").select("leaf", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(1).alias("kind"), "rep", F.lit(None).cast("array<long>").alias("ids"), "vector", "compared")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, ready = None, [], None
        for b in batches:
            leaf, block, kinds = (b.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(block) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if lo == hi:
                    continue
                here, part = (leaf[lo], block[lo]), b.slice(lo, hi - lo)
                if here != key:
                    key, parts, ready = here, [], None
                if kinds[lo] == 0:
                    parts.append((matrix(part.column(5), dim), part.column(4).to_pylist()))
                    continue
                if ready is None:
                    if not parts:
                        continue
                    ids = [i for _, x in parts for i in x]
                    ready = np.vstack([x for x, _ in parts]), np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.array([j for i in ids for j in i])
                x, owner, ids = ready
                q = matrix(part.column(5), dim)
                for at in range(0, len(q), 128):
                    found = list(best(q[at : at + 128] @ x.T, owner, ids, k + 1))
                    yield pa.record_batch({"rep": part.column(3).slice(at, 128), "compared": part.column(6).slice(at, 128), "ids": pa.array([i.tolist() for i, _ in found], pa.list_(pa.int64())), "scores": pa.array([s.tolist() for _, s in found], pa.list_(pa.float64()))})

    dealt = held.unionByName(asking).repartition(partitions(spark), "leaf", "block").sortWithinPartitions("leaf", "block", "kind")
    found = dealt.mapInArrow(compare, "rep long, compared long, ids array<long>, scores array<double>")

    # least first: the negated score, then the id
    near = found.select("rep", "compared", F.explode(F.expr("transform(arrays_zip(scores, ids), x -> struct(-x.scores as s, x.ids as i))")).alias("x")).select("rep", "compared", "x.*")
    top = near.withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy("s", "i"))).where(F.col("r") <= k + 1)
    top = table(top.groupBy("rep").agg(F.max("compared").alias("compared"), F.sort_array(F.collect_list(F.struct("s", "i"))).alias("near")), "nearest")
    # a class's queries, of which there may be very many, share its row
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asked_by = queries.groupBy("vector").agg(F.count("*").alias("c"))
    of_class = classes.where("asked").select("vector", "rep").join(top, "rep").drop("rep")
    out = joined(queries, of_class, "vector", asked_by).where("near is not null")
    own = out.select("query_id", "compared", F.expr(f"slice(filter(near, x -> x.i != query_id), 1, {k})").alias("near"))
    ranked = own.select("query_id", "compared", F.posexplode("near").alias("p", "x"))
    return ranked.select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"), "compared")


def kind(df: DataFrame) -> str:
    return df.schema["vector"].dataType.simpleString()


def _calibrate(index: DataFrame, tree: Tree, dim: int, k: int, target: float, trials: int) -> int:
    """How many leaves to visit: true neighbours over all rows of at most ``trials`` queries tell."""
    asked = index.where("asked").orderBy(F.xxhash64("rep"), "rep").select("rep", "vector").limit(trials).toArrow()
    q, reps = matrix(asked.column(1), dim), asked.column(0).to_pylist()
    if not reps:
        return 1
    sent = index.sparkSession.sparkContext.broadcast(q)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list[tuple[float, int, int]]] = [[] for _ in sent.value]
        for b in batches:
            ids, leaf = b.column(1).to_pylist(), b.column(4).to_numpy()
            owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
            if len(owner):
                flat = np.array([j for i in ids for j in i])
                place = dict(zip(flat.tolist(), leaf[owner].tolist(), strict=True))
                for t, (i, s) in zip(top, best(sent.value @ matrix(b.column(2), dim).T, owner, flat, k + 1), strict=True):
                    t += [(-x, y, place[y]) for x, y in zip(s.tolist(), i.tolist(), strict=True)]
                    t.sort()
                    del t[k + 1 :]
        rows = [(i, *x) for i, t in enumerate(top) for x in t]
        yield pa.record_batch({n: pa.array([r[j] for r in rows], kind) for j, (n, kind) in enumerate((("q", pa.int32()), ("s", pa.float64()), ("i", pa.int64()), ("leaf", pa.int64())))})

    near = index.mapInArrow(task, "q int, s double, i long, leaf long")
    top = near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("s", "i"))).where(F.col("r") <= k + 1).collect()
    order = [{leaf: r for r, leaf in enumerate(tree.visits(np.append(x, 0.0), len(tree.leaf)))} for x in q]
    needed = sorted(order[r.q][r.leaf] + 1 for r in top if r.i != reps[r.q])
    return needed[min(len(needed) - 1, int(target * len(needed)))] if needed else 1
