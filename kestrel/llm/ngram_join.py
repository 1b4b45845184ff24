"""Jaccard self-join of documents on word n-grams by prefix trees.

Every distinct n-gram set is put in one global order (common n-grams last, then
by hash).  Two sets that are similar enough must share n-grams near the front of
that order, so only those fronts are exchanged to find out which sets may meet.
Sets that may meet form branches; a branch is one task, and a heavy branch is
split into parts that meet in pairs.  A task puts one side's sets into a trie (a
shared front is one path) and takes the other side's sets through it many at a
time: the overlaps of a path with all of them are reused by every set below it,
and a subtree is left as soon as the lengths that remain cannot reach the
threshold for any of them.  Of a task's links, only what they connect leaves it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import byte_slices, lower_ascii, mix64, text_buffers, window_hashes, words
from kestrel.llm.components import connected_components
from kestrel.llm.tables import fresh_names, named
from kestrel.session import scratch_path

NUM, DEN = 75, 100              # two sets link when DEN * intersection >= NUM * union
SHARE_SLACK = 0.08              # the front is (1 - threshold + slack) of a set; slack * size of it must be shared
SMALL_RUN = 24                  # sharers of an n-gram that are paired directly
COUNTED = 0.5                   # share of a set (in hash order) whose n-grams are counted for the order
HOT_LIMIT = 1 << 21             # size bound of the list of common n-grams (16 MB)
BRANCH_GRAMS = 1 << 19          # n-grams of the sets that meet in one task (4 MB)
PROBES = 256                    # sets taken through a trie at a time
STEP = 128                      # n-grams of a path between two looks at the remaining lengths
ENTRIES_PER_BUCKET = 500_000
WORK_BYTES = 2 << 20            # text hashed at a time
FEW_IDS = 500_000               # rows of ids or places that may be broadcast (at most 20 MB); beyond, a shuffle join


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- n-gram sets
def ngram_sets(offsets: np.ndarray, raw: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes per text; a text of fewer words is one n-gram of all its words."""
    w = words(raw, offsets)
    h = w.hashes(lower_ascii(raw))
    grams = window_hashes(h, n)
    out = []
    for a, b in zip(w.bounds[:-1], w.bounds[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(mix64(window_hashes(h[a:b], int(b - a)) ^ np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _least_shared(size: np.ndarray | int):
    """n-grams that the fronts of two linked sets share at least (the smaller size decides)."""
    return np.maximum(1, np.asarray(size * SHARE_SLACK).astype(np.int64))


def front_length(size: int) -> int:
    """Length of a set's front: at most ``size - need`` of its n-grams are missing from a linked set."""
    need = -(-NUM * size // DEN)
    return min(size, size - need + int(_least_shared(size)))


def _gram_ids(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of each n-gram as one number; two n-grams alike in it only add a candidate."""
    return (grams % np.uint64(buckets)) << np.uint64(32) | (grams // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)


def _ordered(s: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """The set in global order: by hash, common n-grams last."""
    if not len(hot) or not len(s):
        return s
    ids = _gram_ids(s, buckets)
    common = hot[np.minimum(np.searchsorted(hot, ids), len(hot) - 1)] == ids
    return np.concatenate((s[~common], s[common]))


def _set_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A document's set size, digest and the digest's first 64 bits as a key."""
    for part in byte_slices(batches, "text", WORK_BYTES):
        sets = ngram_sets(*text_buffers(part.column("text")), n)
        digests = [_digest(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
             pa.array([d and _key(d) for d in digests], pa.int64())], ["doc_id", "size", "digest", "key"])


# ---------------------------------------------------------------- candidates
def _packed(parts: list[np.ndarray], owners: list[np.ndarray] | None, buckets: int) -> pa.RecordBatch:
    """n-grams (32 bits each) and, if given, the keys of their sets, one row per bucket."""
    grams = np.concatenate(parts)
    bucket = (grams % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, rest = bucket[order], (grams[order] // np.uint64(buckets)).astype(np.uint32)
    edge = np.flatnonzero(np.diff(bucket, prepend=-1))
    spans = list(zip(edge, np.append(edge[1:], len(bucket))))
    cols = [pa.array(bucket[edge]), pa.array([rest[a:b].tobytes() for a, b in spans], pa.binary())]
    if owners is not None:
        keys = np.concatenate(owners)[order]
        cols.append(pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, ["bucket", "grams", "keys"][:len(cols)])


def _front_batches(batches: Iterator[pa.RecordBatch], n: int, buckets: int, hot: np.ndarray | None,
                   held_limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The fronts of the stretch's distinct sets, packed per bucket.

    Without ``hot``: the first COUNTED of each set by hash, n-grams alone, for counting.
    """
    seen: set[int] = set()
    parts, owners, held = [], [], 0
    for part in byte_slices(batches, "text", WORK_BYTES):
        for s in ngram_sets(*text_buffers(part.column("text")), n):
            if not len(s) or (key := _key(_digest(s))) in seen:    # copies met before add nothing
                continue
            seen.add(key)
            if hot is None:
                parts.append(s[:int(len(s) * COUNTED) + 1])
            else:
                parts.append(_ordered(s, hot, buckets)[:front_length(len(s))])
                owners.append(np.full(len(parts[-1]), key, dtype=np.int64))
            held += len(parts[-1])
        if held > held_limit:
            yield _packed(parts, owners if hot is not None else None, buckets)
            parts, owners, held, seen = [], [], 0, set()
    if held:
        yield _packed(parts, owners if hot is not None else None, buckets)


def _buckets_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]):
    """(bucket, joined bytes of each column) of rows that arrive sorted by bucket; one bucket is held at a time."""
    now, held = None, [[] for _ in columns]
    for batch in batches:
        for bucket, *blobs in zip(*(batch.column(c).to_pylist() for c in ("bucket", *columns))):
            if bucket != now and now is not None:
                yield now, [b"".join(h) for h in held]
                held = [[] for _ in columns]
            now = bucket
            for h, b in zip(held, blobs):
                h.append(b)
    if now is not None:
        yield now, [b"".join(h) for h in held]


def _common_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of more than SMALL_RUN sharers, with counts."""
    for bucket, (blob,) in _buckets_of(batches, ("grams",)):
        grams, count = np.unique(np.frombuffer(blob, dtype=np.uint32), return_counts=True)
        many = count > SMALL_RUN
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket << 32 | grams[many].astype(np.int64)), pa.array(count[many].astype(np.int64))], ["gram", "count"])


def _count_pairs(a: list[np.ndarray], b: list[np.ndarray]):
    """Distinct (a, b) with counts."""
    if not a:
        return (np.zeros(0, np.int64),) * 3
    pairs = np.stack((np.concatenate(a), np.concatenate(b)), 1)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    new = np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))
    at = np.flatnonzero(new)
    return pairs[at, 0], pairs[at, 1], np.diff(np.append(at, len(pairs)))


def _bucket_candidates(bucket: int, grams: np.ndarray, keys: np.ndarray):
    """Kind 0: pairs sharing an n-gram of few sharers, with counts.  Kind 1: where sharers are many, the first and the
    last (by key) with every other, with counts.  Kind 2: those n-grams with each sharer and, as count, the first one."""
    order = np.lexsort((keys, grams))
    grams, keys = grams[order], keys[order]
    new = np.append(True, (grams[1:] != grams[:-1]) | (keys[1:] != keys[:-1]))   # a set met in two stretches counts once
    grams, keys = grams[new], keys[new]
    start = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    length = np.diff(np.append(start, len(grams)))
    a, b = [], []
    for size in range(2, SMALL_RUN + 1):
        runs = start[length == size]
        if len(runs):
            i, j = np.triu_indices(size, 1)
            a.append(keys[runs[:, None] + i].ravel())
            b.append(keys[runs[:, None] + j].ravel())
    yield 0, *_count_pairs(a, b)
    a, b, gram, member, pivot = [], [], [], [], []
    for s, m in zip(start[length > SMALL_RUN], length[length > SMALL_RUN]):
        own = keys[s:s + m]
        a += [np.full(m - 1, own[0]), own[1:-1]]
        b += [own[1:], np.full(m - 2, own[-1])]
        gram.append(np.full(m, bucket << 32 | int(grams[s]), dtype=np.int64))
        member.append(own)
        pivot.append(np.full(m, own[0]))
    yield 1, *_count_pairs(a, b)
    if gram:
        yield 2, np.concatenate(gram), np.concatenate(member), np.concatenate(pivot)


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, (grams, keys) in _buckets_of(batches, ("grams", "keys")):
        for kind, a, b, count in _bucket_candidates(bucket, np.frombuffer(grams, np.uint32), np.frombuffer(keys, np.int64)):
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(count.astype(np.int64))],
                    ["kind", "a", "b", "count"])


# ---------------------------------------------------------------- verification
def needed_overlap(p: int, q: int) -> int:
    """Least intersection of two linked sets of sizes p and q."""
    return -(-NUM * (p + q) // (DEN + NUM))


def _lexicographic(sets: list[np.ndarray]) -> list[int]:
    return sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())


def trie_join(build: list[np.ndarray], probes: list[np.ndarray], step: int = STEP,
              at_once: int = PROBES) -> Iterator[tuple[int, np.ndarray]]:
    """For the sets of ``build`` that link with any of ``probes``: their index and those of the linked probes.

    Inside the task n-grams are ordered commonest first, so that near copies share
    long paths.  The trie is held as the sets in lexicographic order with the depth
    that each shares with its predecessor: row d of ``path`` has the overlaps of
    the first d n-grams of the current path with every probe, and later siblings
    start from there.  n-grams that no probe at hand holds are left out of the
    paths; they only count in the lengths.
    """
    sizes = np.array([len(s) for s in build])
    probe_sizes = np.array([len(s) for s in probes])
    grams, place, holders = np.unique(np.concatenate([*build, *probes]), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), dtype=np.uint32)
    rank[np.argsort(-holders, kind="stable")] = np.arange(len(grams), dtype=np.uint32)
    ranked = [np.sort(r) for r in np.split(rank[place], np.cumsum([*sizes, *probe_sizes])[:-1])]
    build, probes = ranked[:len(build)], ranked[len(build):]
    order, probe_order = _lexicographic(build), _lexicographic(probes)
    flat = np.concatenate([build[i] for i in order])
    edges = np.concatenate(([0], np.cumsum(sizes[order])))
    for k in range(0, len(probes), at_once):
        chunk = probe_order[k:k + at_once]
        q = probe_sizes[chunk]
        present = np.zeros(len(grams), dtype=bool)
        present[np.concatenate([probes[j] for j in chunk])] = True
        row = np.cumsum(present) - 1
        holds = np.zeros((int(present.sum()), len(chunk)), dtype=np.uint8)
        for j, p in enumerate(chunk):
            holds[row[probes[p]], j] = 1
        useful = present[flat]
        kept = np.concatenate(([0], np.cumsum(useful)))[edges]
        rows = row[flat[useful]]
        p = sizes[order]
        # the least overlap over the probes of a size that fits; sets that hold less never enter the trie
        fits = np.maximum(q.min(), -(-NUM * p // DEN))
        enter = np.flatnonzero((fits <= np.minimum(q.max(), DEN * p // NUM)) & (np.diff(kept) >= needed_overlap(p, fits)))
        path = np.zeros((int(np.diff(kept).max(initial=0)) + 1, len(chunk)), dtype=np.int32)
        before, known = np.zeros(0, dtype=np.int64), 0
        for n in enter:
            s = rows[kept[n]:kept[n + 1]]
            m = min(len(before), len(s), known)                    # how far the path's overlaps are known
            differ = np.flatnonzero(before[:m] != s[:m])
            depth = int(differ[0]) if len(differ) else m
            need = needed_overlap(p[n], q)
            while depth < len(s):
                if not (path[depth] + (len(s) - depth) >= need).any():      # remaining lengths cannot reach the threshold
                    break
                piece = holds[s[depth:depth + step]]
                path[depth + 1:depth + 1 + len(piece)] = path[depth] + np.cumsum(piece, axis=0, dtype=np.int32)
                depth += len(piece)
            before, known = s, depth
            if depth == len(s):
                linked = np.flatnonzero(path[depth] >= need)
                if len(linked):
                    yield order[n], np.array(chunk)[linked]


class _Joined:
    """Sets of a task that are known to be connected."""

    def __init__(self):
        self.root: dict = {}

    def find(self, x):
        root = self.root
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up] if up in root else up
        return x

    def join(self, x, y) -> None:
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)


BUILD, PROBE, BOTH = 0, 1, 2


def _connected(sides: list[int], reps: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """``(u, v)``: every set v that the task's links connect with others, and the smallest set u of those."""
    build = [i for i, side in enumerate(sides) if side != PROBE]
    probes = [i for i, side in enumerate(sides) if side != BUILD]
    if not build or not probes:
        return []
    joined = _Joined()
    for i, linked in trie_join([sets[i] for i in build], [sets[i] for i in probes]):
        for j in linked:
            joined.join(reps[build[i]], reps[probes[j]])
    return [(u, v) for v in list(joined.root) if (u := joined.find(v)) != v]


def _branch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``task, side, rep, grams`` arrive sorted by task; one task's sets are held at a time."""
    now, sides, reps, sets, out = None, [], [], [], []

    def rows():
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["u", "v"])
    for batch in batches:
        for task, side, rep, blob in zip(*(batch.column(c) for c in ("task", "side", "rep", "grams"))):
            if (task := task.as_py()) != now:
                out.extend(_connected(sides, reps, sets))
                now, sides, reps, sets = task, [], [], []
            sides.append(side.as_py())
            reps.append(rep.as_py())
            sets.append(np.frombuffer(blob.as_buffer(), dtype=np.uint64))
        if len(out) > 50_000:
            yield rows()
            out = []
    out.extend(_connected(sides, reps, sets))
    yield rows()


def _full_set_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Whole sets of wanted representatives; a repeated id with another text is left out by its digest."""
    for part in byte_slices(batches, "text", WORK_BYTES):
        sets = ngram_sets(*text_buffers(part.column("text")), n)
        keep = [i for i, d in enumerate(part.column("digest").to_pylist()) if _digest(sets[i]) == d]
        yield pa.RecordBatch.from_arrays(
            [part.column("rep").take(pa.array(keep, pa.int64())), pa.array([sets[i].tobytes() for i in keep], pa.binary())],
            ["rep", "grams"])


class NgramJoin:
    """The join over one table of documents; intermediate tables live in shared storage."""

    def __init__(self, docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text"):
        self.spark: SparkSession = docs.sparkSession
        self.n = n
        self.docs = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
        self.rows = _written(self.spark, self.docs.mapInArrow(
            lambda b: _set_batches(b, n), "doc_id long, size long, digest binary, key long"), "ngram-sets")
        # one class per distinct set; rows without an id take no part in links
        classes = _written(self.spark, self.rows.where("size > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("id"), F.min("size").alias("size"), F.min("key").alias("key")), "ngram-classes")
        # the smallest id stands for a class, or its key where an id repeats with another text
        self.repeated = not classes.groupBy("id").count().where("count > 1").isEmpty()
        self.classes = classes.withColumn("rep", F.col("key" if self.repeated else "id"))
        self.same_rows = not self.rows.where("size > 0").groupBy("doc_id").count().where("count > 1").isEmpty()
        entries = self.classes.agg(F.sum(F.col("size") * (1 - NUM / DEN + SHARE_SLACK) + 1)).first()[0] or 0
        self.parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), int(entries / (4 * ENTRIES_PER_BUCKET)))
        self.buckets = 4 * self.parts

    def _fronts(self, hot, schema: str) -> DataFrame:
        """Packed fronts, each bucket's rows together and in order."""
        n, buckets = self.n, self.buckets
        packed = self.docs.where("doc_id IS NOT NULL").select("text").mapInArrow(
            lambda b: _front_batches(b, n, buckets, hot and hot.value), schema)
        return packed.repartition(self.parts, "bucket").sortWithinPartitions("bucket")

    def common_grams(self) -> np.ndarray:
        """Sorted ids of the commonest n-grams: those of more than SMALL_RUN sharers, at most HOT_LIMIT.

        Counted over the fronts of all documents.  Any list gives the same
        links; a good one gives fewer candidates.
        """
        counted = self._fronts(None, "bucket int, grams binary").mapInArrow(_common_batches, "gram long, count long")
        top = counted.orderBy(F.col("count").desc(), "gram").limit(HOT_LIMIT).select("gram").toPandas()
        return np.sort(top["gram"].to_numpy(dtype=np.int64).astype(np.uint64))

    def _pairs(self, shared: DataFrame) -> DataFrame:
        """``u < v, rare, least, common``: pairs of representatives whose sizes allow a link, with the front n-grams that
        they share, must share, and the common ones that both hold at most."""
        c = self._sets
        return (shared.groupBy("a", "b").agg(F.sum("count").alias("rare"))
                .join(c.alias("l"), F.col("a") == F.col("l.key")).join(c.alias("r"), F.col("b") == F.col("r.key"))
                .where((DEN * F.least("l.size", "r.size") >= NUM * F.greatest("l.size", "r.size"))
                       & (F.col("l.rep") != F.col("r.rep")))
                .select(F.least("l.rep", "r.rep").alias("u"), F.greatest("l.rep", "r.rep").alias("v"), "rare",
                        F.least(_least_column("l.size"), _least_column("r.size")).alias("least"),
                        F.least("l.heavy", "r.heavy").alias("common")))

    def _first_candidates(self) -> DataFrame:
        """Pairs that share enough rare n-grams, and stars of common ones; keeps what the second round needs."""
        hot = self.spark.sparkContext.broadcast(self.common_grams())
        found = _written(self.spark, self._fronts(hot, "bucket int, grams binary, keys binary").mapInArrow(
            _candidate_batches, "kind int, a long, b long, count long"), "ngram-candidates")
        self._members = found.where("kind = 2").select(F.col("a").alias("gram"), F.col("b").alias("key"),
                                                       F.col("count").alias("pivot"))
        heavy = self._members.groupBy("key").agg(F.count("*").alias("heavy"))
        self._sets = _written(self.spark, self.classes.join(heavy, "key", "left").select(
            "key", "rep", "size", F.coalesce("heavy", F.lit(0)).alias("heavy")), "ngram-heavy")
        few = self._pairs(found.where("kind = 0")).where("rare + common >= least")
        self._few = _written(self.spark, few, "ngram-few")
        stars = self._pairs(found.where("kind = 1")).where("rare >= least")
        return _written(self.spark, self._few.where("rare >= least").unionAll(stars).select("u", "v").distinct(), "ngram-pairs")

    def _branches_of_pairs(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(``task, side, rep`` of sets that meet because of the pairs, ``node, branch, parts``).

        A set belongs to the branch of the smallest set within two pairs of it, and
        a branch too heavy for a task is dealt into parts.  All sets of a branch (or
        part) meet in one task; besides, two branches (or parts) meet with those of
        their sets that have a pair across.
        """
        spark = self.spark
        both = pairs.select("u", "v").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _written(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "ngram-near")
        there = near.select(F.col("u").alias("v"), F.col("least").alias("there"))
        branch = both.join(there, "v").groupBy("u").agg(F.min("there").alias("there")).join(near, "u").select(
            F.col("u").alias("node"), F.least("there", "least").alias("start"))
        branch = _written(spark, branch.join(self.classes.select(F.col("rep").alias("node"), "size"), "node"), "ngram-starts")
        weight = branch.groupBy("start").agg(F.ceil(2 * F.sum("size") / BRANCH_GRAMS).cast("int").alias("halves"))
        parts = F.when(F.col("halves") <= 2, 1).otherwise(F.col("halves"))
        branch = branch.join(weight, "start").withColumn("parts", parts).select(
            "node", F.xxhash64(F.lit("branch"), "start", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("branch"), "parts")
        branch = _written(spark, branch, "ngram-branches")
        own = branch.select(F.xxhash64("branch", "branch").alias("task"), F.lit(BOTH).alias("side"), F.col("node").alias("rep"))
        l, r = (branch.select(F.col("node").alias(e), F.col("branch").alias("branch" + e)) for e in ("u", "v"))
        across = pairs.select("u", "v").join(l, "u").join(r, "v").where("branchu != branchv")
        ends = across.select(
            F.xxhash64(F.least("branchu", "branchv"), F.greatest("branchu", "branchv")).alias("task"),
            F.explode(F.array(
                F.struct(F.when(F.col("branchu") < F.col("branchv"), BUILD).otherwise(PROBE).alias("side"), F.col("u").alias("rep")),
                F.struct(F.when(F.col("branchv") < F.col("branchu"), BUILD).otherwise(PROBE).alias("side"), F.col("v").alias("rep")),
            )).alias("end"))
        return own.unionAll(ends.select("task", "end.side", "end.rep").distinct()), branch

    def _links_of(self, placed: DataFrame) -> DataFrame:
        """Spanning links ``u, v`` of the tasks in ``placed``; every set is read once and goes to each of its tasks."""
        spark, n = self.spark, self.n
        placed = _written(spark, placed, "ngram-placed")
        ids = placed.select("rep").distinct().join(self.classes, "rep").select("rep", "digest", "id")
        ids = _small(_written(spark, ids, "ngram-wanted"))
        sets = self.docs.join(ids, F.col("doc_id") == F.col("id")).select("rep", "digest", "text").mapInArrow(
            lambda b: _full_set_batches(b, n), "rep long, grams binary")
        if self.same_rows:
            sets = sets.dropDuplicates(["rep"])
        rows = sets.join(_small(placed), "rep").select("task", "side", "rep", "grams")
        rows = rows.repartition("task").sortWithinPartitions("task")
        return _written(spark, rows.mapInArrow(_branch_batches, "u long, v long"), "ngram-links")

    def _second_branches(self, label: DataFrame) -> DataFrame:
        """``task, side, rep`` of what the first round left open; sets of one label are done with each other.

        A linked pair shares ``least`` front n-grams.  Either some of them are
        rare, and the common ones of both sets make up for the rest; or all are
        common, and both sets hold that many.
        """
        spark = self.spark
        sets = _written(spark, self._sets.where("heavy > 0").join(label, F.col("rep") == F.col("node"), "left").select(
            "key", "rep", "size", "heavy", F.coalesce("label", "rep").alias("label")), "ngram-labels")
        held = self._members.groupBy("key", "pivot").agg(F.count("*").alias("n"))
        held = _written(spark, held.join(sets, "key").select("pivot", "rep", "n", "size", "heavy", "label"), "ngram-held")
        # pairs of some rare n-grams: common ones are shared under the same pivot, or not at all
        l, r = (held.select(F.col("rep").alias(e), "pivot", F.col("n").alias("n" + e), F.col("label").alias("label" + e))
                for e in ("u", "v"))
        mixed = (self._few.where("rare < least").join(l, "u").join(r, ["v", "pivot"]).where("labelu != labelv")
                 .groupBy("u", "v", "rare", "least").agg(F.sum(F.least("nu", "nv")).alias("common"))
                 .where("rare + common >= least").select("u", "v"))
        mixed = _written(spark, mixed, "ngram-mixed")
        # sets of enough common n-grams meet under the pivots of those n-grams
        many = held.where(F.col("heavy") >= _least_column("size"))
        weights = many.groupBy("pivot", "label").agg(F.sum("size").alias("weight"))
        most = weights.groupBy("pivot").agg(
            F.max_by("label", F.struct("weight", "label")).alias("main"), F.max("weight").alias("main_weight"),
            F.sum("weight").alias("all"), F.count("*").alias("labels")).where("labels > 1")
        half = BRANCH_GRAMS / 2
        light = F.col("all") <= BRANCH_GRAMS
        most = most.select("pivot", "main", F.when(light, 1).otherwise(
            F.ceil((F.col("all") - F.col("main_weight")) / half)).cast("int").alias("rest_parts"),
            F.when(light, 0).otherwise(F.ceil(F.col("main_weight") / half)).cast("int").alias("main_parts"))
        rows = many.join(most, "pivot")
        # a heavy branch: sets of the commonest label, which are done with each other, meet the rest's parts only
        in_main = (F.col("main_parts") > 0) & (F.col("label") == F.col("main"))
        dealt = F.xxhash64("rep")
        rows = rows.withColumn("part", F.when(in_main, F.col("rest_parts") + F.pmod(dealt, F.greatest("main_parts", F.lit(1))))
                               .otherwise(F.pmod(dealt, F.col("rest_parts"))).cast("int"))
        meets = F.when(in_main, F.sequence(F.lit(0), F.col("rest_parts") - 1)).otherwise(
            F.sequence(F.lit(0), F.col("rest_parts") + F.col("main_parts") - 1))
        rows = rows.select("pivot", "rep", "part", F.explode(meets).alias("other"))
        low, high = F.least("part", "other"), F.greatest("part", "other")
        common = rows.select(F.xxhash64(F.lit("common"), "pivot", low, high).alias("task"),
                             F.when(low == high, BOTH).when(F.col("part") == low, BUILD).otherwise(PROBE).alias("side"), "rep")
        if mixed.isEmpty():
            return common
        return common.unionAll(self._branches_of_pairs(mixed)[0])

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(``u, v`` of representatives that verified links connect, ``node, component``).

        They connect exactly the documents that the join links; what a task's links
        connect is listed as a star around its smallest set.
        """
        placed, branch = self._branches_of_pairs(self._first_candidates())
        first = self._links_of(placed)
        # the sets of a branch have met; those of a divided one need not meet again where they are connected
        label = branch.select("node", F.col("branch").alias("label"))
        if not branch.where("parts > 1").isEmpty():
            component = connected_components(self.spark, first)
            label = branch.join(component, "node", "left").select("node", F.when(
                F.col("parts") > 1, F.coalesce("component", "branch")).otherwise(F.col("branch")).alias("label"))
        rest = _written(self.spark, self._second_branches(label), "ngram-open")
        every = first if rest.isEmpty() else first.unionByName(self._links_of(rest))
        return every, connected_components(self.spark, every)

    def members(self) -> DataFrame:
        """``doc_id, n_shingles, component_id, key, node``: one row per input row; ``node`` tells components apart even
        where their smallest id is the same."""
        _, component = self.links()
        classes = self.classes.join(component, F.col("rep") == F.col("node"), "left").select(
            "digest", "id", F.coalesce("component", "rep").alias("node"))
        if self.repeated:
            classes = _written(self.spark, classes, "ngram-nodes")
            least = _written(self.spark, classes.groupBy("node").agg(F.min("id").alias("component_id")), "ngram-labels")
            classes = classes.join(F.broadcast(least) if least.count() <= FEW_IDS else least, "node")
        else:
            classes = classes.withColumn("component_id", F.col("node"))
        return self.rows.join(classes.drop("id"), "digest", "left").select(
            "doc_id", F.col("size").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), "key", "node")

    def memberships(self) -> DataFrame:
        """``doc_id, n_shingles, component_id``: one row per input row."""
        return self.members().select("doc_id", "n_shingles", "component_id")


def _least_column(size: str):
    return F.greatest(F.lit(1), F.floor(F.col(size) * SHARE_SLACK).cast("long"))


def keep_one_per_component(docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns as they are, with one document left of each near-duplicate class.

    The document with the smallest id of a class stays.  Of rows that repeat an id
    with the same n-gram set one stays; an id's different texts are different
    documents, each judged by itself (of a class that holds two texts of its
    smallest id, the one with the smaller key stays).  Rows without an id are
    never judged copies and stay.
    """
    spark = docs.sparkSession
    members = _written(spark, NgramJoin(docs, n, id_col, text_col).members(), "ngram-members").where("doc_id IS NOT NULL")
    key = F.coalesce("key", F.lit(0))                              # 0: no words
    per_id = members.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("component_id").alias("component_id"),
                                           (F.min(key) != F.max(key)).alias("differ"))
    # helper columns get names that no input column has
    new = fresh_names(docs.columns, "id", "gone", "gone_key", "key")
    differ = _written(spark, per_id.where("differ").select(F.col("doc_id").alias(new["id"])), "ngram-differ")
    own, long = named(id_col), named(id_col).cast("long")
    if differ.isEmpty():
        gone = per_id.where("component_id != doc_id").select(F.col("doc_id").alias(new["gone"]))
        kept, apart = docs.join(_small(gone), long == F.col(new["gone"]), "left_anti"), None
    else:
        first = members.where("key IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("first"))
        gone = _written(spark, members.join(first, "node").where(F.struct("doc_id", "key") != F.col("first")).select(
            F.col("doc_id").alias(new["gone"]), F.col("key").alias(new["gone_key"])).distinct(), "ngram-gone")
        some = _small(differ)
        kept = docs.join(some, long == F.col(new["id"]), "left_anti").join(
            _small(gone.select(new["gone"]).distinct()), long == F.col(new["gone"]), "left_anti")
        apart = (docs.join(some, long == F.col(new["id"]), "left_semi")
                 .withColumn(new["key"], _set_key(n)(named(text_col).cast("string")))
                 .join(_small(gone), (long == F.col(new["gone"])) & (F.col(new["key"]) == F.col(new["gone_key"])), "left_anti")
                 .dropDuplicates([id_col, new["key"]]).drop(new["key"]))
    if not per_id.where("rows > 1 AND NOT differ").isEmpty():
        kept = kept.where(own.isNotNull()).dropDuplicates([id_col]).unionByName(kept.where(own.isNull()))
    return kept if apart is None else kept.unionByName(apart)


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def _set_key(n: int):
    """Column function: the key of a text's n-gram set, null without words."""
    def keys(texts: pd.Series) -> pd.Series:
        sets = ngram_sets(*text_buffers(pa.array(texts, pa.string())), n)
        return pd.Series([_key(_digest(s)) if len(s) else None for s in sets], dtype="Int64")
    return F.pandas_udf(keys, "long")


def ngram_components(docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate classes: documents whose n-gram sets have Jaccard similarity of 0.75 or more are linked.

    Words are runs free of ASCII white space with A-Z lower-cased; a document's
    set holds its distinct ``n``-word shingles, or all its words as one shingle
    when there are fewer; a document without words (empty or null text) has an
    empty set and links with nothing.  Sets are compared by 64-bit hashes of
    shingles, equal sets by a 128-bit digest.

    Returns ``doc_id, n_shingles, component_id`` (the smallest id reachable by
    links), one row per input row.  Repeated rows fall into one class; a repeated
    id with another text is judged by that text alone (two components may then
    have the same smallest id); a row without an id gets a null
    component and links nothing.  Other columns are not read.
    """
    return NgramJoin(docs, n, id_col, text_col).memberships()
