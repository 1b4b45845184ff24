"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Rows near the same pivot share a shard, and every shard's task builds a ball
tree.  A query first searches its most promising shard; its k-th score there is
the bar that it takes to all other shards.  Shards, and nodes within a shard,
whose largest possible inner product stays below the bar are not opened; the
rest are opened in the order of that bound, and the bar rises on the way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import scratch_path

SHARD_ROWS = 4096               # rows of a shard, while there are at most MAX_SHARDS of them
MAX_SHARDS = 4096               # bound of the broadcast balls around whole shards
MAX_BALL_BYTES = 32 << 20       # and of their centres
MAX_PIVOTS = 512
SAMPLE_LIMIT = 8192             # rows among which the pivots are chosen; every row is searched
LEAF_ROWS = 64
QUERY_BLOCK = 2048              # queries about that many at a time meet one shard in one task
SLACK = 1e-9                    # relative room for rounding in the bounds, which only prune

_SHARD = "shard int, center binary, radius double, ids binary, vectors binary, kind string, nodes binary, centers binary, radii binary"


# ---------------------------------------------------------------- one tree
class BallTree:
    """Rows in leaf order and balls over ranges of them; children of node i are in ``nodes[i, 2:]`` (0: a leaf)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, centers: np.ndarray, radii: np.ndarray):
        self.ids, self.vectors, self.nodes, self.centers, self.radii = ids, vectors, nodes, centers, radii
        self.largest = int(max(abs(int(vectors.min(initial=0))), abs(int(vectors.max(initial=0)))))
        self._exact_float = vectors.astype(np.float64)

    @classmethod
    def grow(cls, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
        points = vectors.astype(np.float64)
        order = np.argsort(ids, kind="stable")
        nodes, centers, radii, todo = [], [], [], [(0, len(ids), None)]
        while todo:
            start, end, parent = todo.pop()
            part = points[order[start:end]]
            center = part.mean(axis=0)
            gaps = part - center
            far = np.einsum("ij,ij->i", gaps, gaps)
            at = len(nodes)
            if parent is not None:
                nodes[parent[0]][parent[1]] = at
            nodes.append([start, end, 0, 0])
            centers.append(center)
            radii.append(float(np.sqrt(far.max(initial=0.0))))
            if end - start > leaf_rows:
                # halves along the line between two far points
                one = part[int(far.argmax())]
                away = part - one
                two = part[int(np.einsum("ij,ij->i", away, away).argmax())]
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(part @ (two - one), middle)]
                todo += [(start, start + middle, (at, 2)), (start + middle, end, (at, 3))]
        return cls(ids[order], vectors[order], np.array(nodes, np.int64).reshape(-1, 4), np.array(centers), np.array(radii))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of every query with any row of every node."""
        return upper_bounds(queries, self.centers, self.radii)

    def scores(self, query: np.ndarray, start: int, end: int) -> np.ndarray:
        """Exact inner products with the rows of a range."""
        most = int(np.abs(query.astype(object)).max()) * self.largest * len(query)
        if most < 1 << 53:
            return (self._exact_float[start:end] @ query.astype(np.float64)).astype(np.int64)
        if most < 1 << 63:
            return self.vectors[start:end].astype(np.int64) @ query
        exact = self.vectors[start:end].astype(object) @ query.astype(object)
        return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)

    def search(self, own: int, query: np.ndarray, bound: np.ndarray, k: int, bar: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of at most ``k`` best rows, none below ``bar``; ties go to the smaller id."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        queue = [(-bound[0], 0)] if len(self.nodes) else []
        while queue:
            most, at = heapq.heappop(queue)
            if bar is not None and -most < bar:                    # no open node can reach the bar
                break
            start, end, left, right = self.nodes[at]
            if left:
                heapq.heappush(queue, (-bound[left], left))
                heapq.heappush(queue, (-bound[right], right))
                continue
            found = self.scores(query, start, end)
            keep = self.ids[start:end] != own
            if bar is not None:
                keep &= found >= bar
            if not keep.any():
                continue
            ids, scores = np.concatenate((ids, self.ids[start:end][keep])), np.concatenate((scores, found[keep]))
            best = np.lexsort((ids, -scores.astype(object) if scores.min() == -(1 << 63) else -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                bar = int(scores[-1]) if bar is None else max(bar, int(scores[-1]))
        return ids, scores


def upper_bounds(queries: np.ndarray, centers: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Queries by balls: no row of a ball has a larger inner product with the query."""
    q = queries.astype(np.float64)
    length = np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]
    reach = np.sqrt(np.einsum("ij,ij->i", centers, centers)) + radii
    return q @ centers.T + length * radii * (1 + SLACK) + SLACK * length * reach + 1


# ---------------------------------------------------------------- tasks
def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= vectors.min(initial=0) and vectors.max(initial=0) <= np.iinfo(kind).max:
            return vectors.astype(kind)
    return vectors


def _pivot_batches(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    half = np.einsum("ij,ij->i", pivots, pivots) / 2
    for b in batches:
        if b.num_rows:
            near = (_matrix(b.column("vector")).astype(np.float64) @ pivots.T - half).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32))], [*b.schema.names, "pivot"])


def _grow_shard(leaf_rows: int):
    def grow(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        tree = BallTree.grow(ids, _narrow(_matrix(table.column("vector"))), leaf_rows)
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "center": [tree.centers[0].tobytes()],
            "radius": [float(tree.radii[0])], "ids": [tree.ids.tobytes()], "vectors": [tree.vectors.tobytes()],
            "kind": [tree.vectors.dtype.str], "nodes": [tree.nodes.tobytes()], "centers": [tree.centers.tobytes()],
            "radii": [tree.radii.tobytes()]})
    return grow


def _tree(row: dict, dim: int) -> BallTree:
    return BallTree(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], row["kind"]).reshape(-1, dim),
                    np.frombuffer(row["nodes"], np.int64).reshape(-1, 4),
                    np.frombuffer(row["centers"], np.float64).reshape(-1, dim), np.frombuffer(row["radii"], np.float64))


def _home_batches(batches: Iterator[pa.RecordBatch], shards: np.ndarray, centers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Every query with the shard whose centre it has the largest inner product with."""
    for b in batches:
        if b.num_rows:
            best = (_matrix(b.column("vector")).astype(np.float64) @ centers.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards[best]), b.column("vec_id"), b.column("vector"), pa.nulls(b.num_rows, pa.int64())],
                ["shard", "query_id", "query", "bar"])


def _other_batches(batches: Iterator[pa.RecordBatch], shards: np.ndarray, centers: np.ndarray,
                   radii: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Every query with each further shard that can still reach its bar."""
    for b in batches:
        if not b.num_rows:
            continue
        bound = upper_bounds(_matrix(b.column("query")), centers, radii)
        bar = b.column("bar").cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy(zero_copy_only=False)
        # a bar beyond 2^53 may round up
        open_ = (bound >= bar[:, None] - np.abs(np.where(np.isinf(bar), 0, bar))[:, None] * SLACK) \
            & (b.column("shard").to_numpy()[:, None] != shards)
        for part in np.array_split(np.flatnonzero(open_.any(axis=1)), -(-int(open_.sum()) // 4096) or 1):
            row, at = np.nonzero(open_[part])
            if len(row):
                take = pa.array(part[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards[at]), *(b.column(c).take(take) for c in ("query_id", "query", "bar"))],
                    ["shard", "query_id", "query", "bar"])


def _search_shard(k: int, dim: int):
    def search(_, shard: pa.Table, queries: pa.Table) -> pa.Table:
        out = [], [], []
        if shard.num_rows and queries.num_rows:
            tree = _tree(shard.to_pylist()[0], dim)
            matrix = _matrix(queries.column("query"))
            bounds = tree.bounds(matrix)
            for own, bar, query, bound in zip(queries.column("query_id").to_pylist(), queries.column("bar").to_pylist(),
                                              matrix, bounds):
                ids, scores = tree.search(own, query, bound, k, bar)
                out[0].append(np.full(len(ids), own, np.int64))
                out[1].append(ids)
                out[2].append(scores)
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))
    return search


# ---------------------------------------------------------------- search
def whole_vectors(df: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector``: ``floor(scale * x)`` of every component of the rows that take part.

    Left out: null ids, vectors that are null, empty or hold a null or non-finite
    component, and vectors whose length differs from the commonest (the larger on
    ties).  A repeated id counts once, with its smallest vector.
    """
    v = F.col("vector")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    size = good.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)
    good = good.where(F.size(v) == size.select("d").scalar())
    whole = good.select("vec_id", F.transform(v, lambda x: F.floor(x * scale)).alias("vector"))
    return whole.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Rows of the sample far from each other: the next pivot is the row farthest from those chosen."""
    points = sample.astype(np.float64)
    chosen, far = [0], None
    while len(chosen) < min(wanted, len(points)):
        gaps = points - points[chosen[-1]]
        now = np.einsum("ij,ij->i", gaps, gaps)
        far = now if far is None else np.minimum(far, now)
        if not far.max() > 0:
            break
        chosen.append(int(far.argmax()))
    return points[chosen]


class ShardedBallTrees:
    """Ball trees over the shards of a vector table, in shared storage."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS, seed: int = 3):
        self.spark = spark = rows.sparkSession
        path = scratch_path(spark, "ball-rows")
        rows.write.parquet(path)
        self.rows = rows = spark.read.parquet(path)
        total = rows.count()
        self.empty = total == 0
        if self.empty:
            return
        picked = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(SAMPLE_LIMIT).select("vector").toArrow()
        sample = _matrix(picked.column("vector"))
        self.dim = sample.shape[1]
        most = max(1, min(MAX_SHARDS, MAX_BALL_BYTES // (8 * self.dim)))
        # every pivot may add one shard that is not full
        shard_rows = max(shard_rows, -(-2 * total // most))
        pivots = spark.sparkContext.broadcast(
            choose_pivots(sample, max(1, min(MAX_PIVOTS, most // 2, -(-total // shard_rows)))))
        path = scratch_path(spark, "ball-pivots")
        rows.mapInArrow(lambda b: _pivot_batches(b, pivots.value), "vec_id long, vector array<long>, pivot int").write.parquet(path)
        near = spark.read.parquet(path)
        salts, first = {}, 0                                       # a hot pivot's rows are dealt over several shards
        for r in near.groupBy("pivot").count().orderBy("pivot").collect():
            salts[r["pivot"]] = (first, -(-r["count"] // shard_rows))
            first += salts[r["pivot"]][1]
        deal = F.create_map(*(F.lit(x) for p, (at, n) in salts.items() for x in (p, at)))
        parts = F.create_map(*(F.lit(x) for p, (at, n) in salts.items() for x in (p, n)))
        shard = (deal[F.col("pivot")] + F.pmod(F.xxhash64("vec_id"), parts[F.col("pivot")]).cast("int")).cast("int")
        path = scratch_path(spark, "ball-shards")
        near.select("vec_id", "vector", shard.alias("shard")).groupBy("shard").applyInArrow(
            _grow_shard(leaf_rows), _SHARD).write.parquet(path)
        self.shards = spark.read.parquet(path)
        balls = self.shards.select("shard", "center", "radius").orderBy("shard").toArrow()
        self.balls = spark.sparkContext.broadcast((
            balls.column("shard").to_numpy(), np.frombuffer(b"".join(balls.column("center").to_pylist())).reshape(-1, self.dim),
            balls.column("radius").to_numpy()))

    def _searched(self, routed: DataFrame, blocks: int, k: int) -> DataFrame:
        """Results of queries that were sent to shards; a shard meets them in blocks."""
        path = scratch_path(self.spark, "ball-routed")
        routed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).write.parquet(path)
        routed = self.spark.read.parquet(path)
        shards = self.shards.join(routed.select("shard", "block").distinct(), "shard")
        columns = [*self.shards.columns, "block"]
        # new columns, so that the two sides can be told apart
        shards, queries = shards.select(*columns).toDF(*columns), routed.toDF(*routed.columns)
        found = shards.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(
            _search_shard(k, self.dim), "query_id long, vec_id long, score long")
        path = scratch_path(self.spark, "ball-found")
        found.write.parquet(path)
        return self.spark.read.parquet(path)

    def top_k(self, queries: DataFrame, k: int) -> DataFrame:
        """``query_id, rank, vec_id, score`` of ``queries`` (``vec_id, vector``); a query's own row is no candidate."""
        if self.empty:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        balls, dim = self.balls, self.dim
        blocks = max(1, -(-queries.count() // QUERY_BLOCK))
        kind = "shard int, query_id long, query array<long>, bar long"
        home = queries.select("vec_id", "vector").mapInArrow(lambda b: _home_batches(b, *balls.value[:2]), kind)
        path = scratch_path(self.spark, "ball-home")
        home.write.parquet(path)
        home = self.spark.read.parquet(path)
        first = self._searched(home, blocks, k)
        bars = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bar"))
        rest = home.drop("bar").join(bars, "query_id", "left").select("shard", "query_id", "query", "bar").mapInArrow(
            lambda b: _other_batches(b, *balls.value), kind)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return first.unionAll(self._searched(rest, blocks, k)).withColumn("rank", F.row_number().over(order)).where(
            F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_top_k(df: DataFrame, query_every: int = 100, k: int = 10, scale: int = 1024, shard_rows: int = SHARD_ROWS,
                leaf_rows: int = LEAF_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` candidates of largest whole-number inner product of every query: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``.  Queries are the rows that take part
    (:func:`whole_vectors`) with an id divisible by ``query_every``, candidates
    all of them but the query's own.  Fewer than ``k`` candidates give all; ties
    go to the smaller id; components and scores beyond 64 bits are clamped to
    them.  An empty table gives an empty result; other columns are not read.

    Broadcast are the pivots (chosen in a sample of ``SAMPLE_LIMIT`` rows) and one
    ball per shard, of which there are at most ``MAX_SHARDS``; on larger tables
    shards grow instead.
    """
    trees = ShardedBallTrees(whole_vectors(df, scale, id_col, vector_col), shard_rows, leaf_rows)
    return trees.top_k(trees.rows.where(F.col("vec_id") % query_every == 0), k)
