"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample; every row is then sent down every tree to
its leaf.  A query walks all trees through one priority queue (the region whose
dividing planes are nearest comes first) until the leaves it has opened hold
enough rows.  Queries and rows meet leaf by leaf, where candidates are ranked
exactly; only each leaf's best go on to the final ranking.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import scratch_path

SAMPLE_LIMIT = 8192             # rows the trees are fitted on
TREES = 24
LEAF_ROWS = 128                 # rows per leaf the fit aims at
SEARCH_SHARE, SEARCH_LEAST = 0.55, 12_000   # rows a query opens: this share of all, at least so many
FLOOR_ROWS = 256                # sample rows that give a query its first threshold (none below ten times as many rows)
_NEAR_TIE = 1e-9


@dataclass
class Tree:
    """Planes (``normal . x <= cut`` goes left); a child below zero is leaf ``-child - 1``."""

    normal: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every row of ``x``."""
        at = np.zeros(len(x), dtype=np.int64) if len(self.cut) else np.full(len(x), -1)
        while True:
            open_ = np.flatnonzero(at >= 0)
            if not len(open_):
                return -at - 1
            n = at[open_]
            side = np.einsum("ij,ij->i", x[open_], self.normal[n]) <= self.cut[n]
            at[open_] = np.where(side, self.left[n], self.right[n])


def grow_tree(sample: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """Split at the median along the difference of two random rows until leaves hold ``leaf_rows`` of the sample.

    Rows that no plane tells apart (repeats) stay together in one leaf.
    """
    normal, cut, left, right, leaves = [], [], [], [], 0

    def leaf() -> int:
        nonlocal leaves
        leaves += 1
        return -leaves
    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        me = None
        if len(rows) > leaf_rows:
            for _ in range(4):                                     # a pair of equal rows gives no plane
                a, b = sample[rng.choice(rows, 2, replace=False)]
                v = a - b
                size = np.linalg.norm(v)
                if size > 1e-12:
                    p = sample[rows] @ (v / size)
                    c = np.median(p)
                    low = p <= c
                    if 0 < low.sum() < len(rows):
                        me = len(cut)
                        normal.append(v / size)
                        cut.append(c)
                        left.append(0)
                        right.append(0)
                        todo += [(rows[low], me, 0), (rows[~low], me, 1)]
                        break
        number = leaf() if me is None else me
        if parent is not None:
            (left if side == 0 else right)[parent] = number
    dims = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(normal).reshape(-1, dims), np.array(cut), np.array(left, dtype=np.int64),
                np.array(right, dtype=np.int64), leaves)


def search_leaves(forest: list[Tree], filled: list[np.ndarray], q: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order a shared priority queue opens them, until they hold ``enough`` rows."""
    side = [t.normal @ q - t.cut for t in forest]
    queue = [(0.0, k, 0 if len(t.cut) else -1) for k, t in enumerate(forest)]
    heapq.heapify(queue)
    out, held = [], 0
    while queue and held < enough:
        far, k, node = heapq.heappop(queue)
        if node < 0:
            if n := int(filled[k][-node - 1]):
                out.append((k, -node - 1))
                held += n
            continue
        t, m = forest[k], float(side[k][node])
        near, other = (t.left[node], t.right[node]) if m <= 0 else (t.right[node], t.left[node])
        heapq.heappush(queue, (far, k, int(near)))
        heapq.heappush(queue, (far + m * m, k, int(other)))
    return out


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of equally long float lists as a float64 matrix."""
    n = len(col)
    values = col.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision; the same pair gives the same bits anywhere."""
    return (np.ascontiguousarray(a) * np.ascontiguousarray(b)).sum(axis=1)


def _leaf_batches(batches: Iterator[pa.RecordBatch], forest: list[Tree]) -> Iterator[pa.RecordBatch]:
    """Every row once per tree, tagged with its leaf."""
    for batch in batches:
        x = _matrix(batch.column("vector"))
        for k, t in enumerate(forest):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), k, np.int32)), pa.array(t.leaf_of(x).astype(np.int32)), batch.column("vec_id"),
                 batch.column("vector")], ["tree", "leaf", "vec_id", "vector"])


def _search_batches(batches: Iterator[pa.RecordBatch], forest, filled, sample, k: int, enough: int):
    """The leaves every query opens, with a score that far more than k rows reach (what stays below is not passed on)."""
    for batch in batches:
        x = _matrix(batch.column("vector"))
        for a in range(0, len(x), 256):
            own = x[a:a + 256]
            scores = own @ sample.T                                # k + 1: the query itself may be among them
            floor = (-np.partition(-scores, k, axis=1)[:, k] if scores.shape[1] > k else np.full(len(own), -np.inf))
            tree, leaf, row = [], [], []
            for i, q in enumerate(own):
                found = search_leaves(forest, filled, q, enough)
                tree += [f[0] for f in found]
                leaf += [f[1] for f in found]
                row += [i] * len(found)
            at = np.array(row, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), batch.column("vec_id").take(pa.array(at + a)),
                 batch.column("vector").take(pa.array(at + a)), pa.array(floor[at], pa.float64())],
                ["tree", "leaf", "vec_id", "vector", "floor"])


def _rank_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (tree, leaf), a leaf's rows before its queries; yields each query's best of the leaf."""
    now, ids, held, ready = None, [], [], None
    for batch in batches:
        tree, leaf = batch.column("tree").to_numpy(), batch.column("leaf").to_numpy()
        is_query = batch.column("is_query").to_numpy(zero_copy_only=False)
        vec_id, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"))
        floor = batch.column("floor").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((np.diff(tree) != 0) | (np.diff(leaf) != 0) | (np.diff(is_query) != 0)) + 1
        for a, b in zip(np.append(0, cut), np.append(cut, len(tree))):
            if (tree[a], leaf[a]) != now:
                now, ids, held, ready = (tree[a], leaf[a]), [], [], None
            if not is_query[a]:
                ids.append(vec_id[a:b])
                held.append(x[a:b])
                ready = None
                continue
            if not ids:
                continue
            if ready is None:
                ready = (np.concatenate(ids), np.concatenate(held))
            yield from _best(vec_id[a:b], x[a:b], floor[a:b], *ready, k)


def _best(q_id, q, floor, v_id, v, k):
    out_q, out_v, out_s = [], [], []
    for a in range(0, len(q), 512):
        scores = q[a:a + 512] @ v.T
        scores[q_id[a:a + 512, None] == v_id[None]] = -np.inf
        least = floor[a:a + 512]
        if len(v) > k:                                             # ties and rounding of the k-th stay in
            least = np.maximum(least, -np.partition(-scores, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero((scores >= least[:, None] - _NEAR_TIE) & (scores > -np.inf))
        out_q.append(q_id[a + i])
        out_v.append(v_id[j])
        out_s.append(exact_products(q[a + i], v[j]))
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_v)),
                                      pa.array(np.concatenate(out_s))], ["query_id", "vec_id", "score"])


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of rows that take part.

    Left out: null ids, vectors that are null, empty, zero or hold a null or
    non-finite component, and vectors whose length differs from the commonest
    (the larger on ties).  A repeated id counts once, with its smallest vector.
    """
    v = F.col("vector")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("vector"))
    good = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0))
    size = good.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)
    good = good.where(F.size(v) == size.select("d").scalar())
    return good.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nearest(df: DataFrame, query_every: int = 20, k: int = 20, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
            search_share: float = SEARCH_SHARE, search_least: int = SEARCH_LEAST, sample_limit: int = SAMPLE_LIMIT,
            seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` nearest rows by inner product: ``query_id, rank, vec_id, score``.

    Queries are the usable rows (see :func:`usable_vectors`) whose id is divisible
    by ``query_every``; candidates are all usable rows but the query's own.  Ties
    go to the smaller id.  Of rows with the same vector only the ``k + 1`` smallest
    ids can ever be among the nearest, so the index holds those; the cut is made
    per task before the shuffle.  The forest (at most ``sample_limit`` rows fit
    it) and that sample are what is broadcast.  An empty table gives an empty
    result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ann-vectors")
    usable_vectors(df, id_col, vector_col).write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample_limit).select("vector").toArrow()
    sample = _matrix(picked.column("vector").combine_chunks()) if total else np.zeros((0, 1))
    rng = np.random.default_rng(seed)
    in_sample = max(8, int(leaf_rows * len(sample) / max(total, 1)))
    forest = spark.sparkContext.broadcast([grow_tree(sample, in_sample, rng) for _ in range(trees)])
    own = Window.partitionBy("vector").orderBy("vec_id")
    distinct = rows.withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k + 1).select("vec_id", "vector")
    placed = distinct.mapInArrow(lambda b: _leaf_batches(b, forest.value),
                                 "tree int, leaf int, vec_id long, vector array<float>")
    path = scratch_path(spark, "ann-index")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    filled = [np.zeros(max(t.leaves, 1), dtype=np.int64) for t in forest.value]
    for r in placed.groupBy("tree", "leaf").count().collect():     # one number per leaf of the bounded forest
        filled[r["tree"]][r["leaf"]] = r["count"]
    known = spark.sparkContext.broadcast((filled, sample[:FLOOR_ROWS if total >= 10 * FLOOR_ROWS else 0]))
    enough = max(search_least, int(search_share * total))
    queries = rows.where(F.col("vec_id") % query_every == 0).mapInArrow(
        lambda b: _search_batches(b, forest.value, *known.value, k, enough),
        "tree int, leaf int, vec_id long, vector array<float>, floor double")
    met = placed.select("tree", "leaf", F.lit(False).alias("is_query"), "vec_id", "vector", F.lit(0.0).alias("floor")).unionAll(
        queries.select("tree", "leaf", F.lit(True).alias("is_query"), "vec_id", "vector", "floor"))
    ranked = (met.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "is_query")
              .mapInArrow(lambda b: _rank_batches(b, k), "query_id long, vec_id long, score double"))
    best = ranked.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))   # met in several trees
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
