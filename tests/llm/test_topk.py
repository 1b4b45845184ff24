"""Exact top-k search by ball trees against brute force."""

import numpy as np
import pytest

from kestrel.llm import ball_tree
from kestrel.llm.queries import ORACLES, QUERIES

COLUMNS = ["query_id", "rank", "vec_id", "score"]


def brute(vectors, every, k):
    """``{id: list of whole numbers}`` searched one by one in Python's own integers."""
    out = set()
    for q in (i for i in vectors if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], vectors[c])), c) for c in vectors if c != q)[:k]
        out |= {(q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1)}
    return out


def rows_of(df):
    got = df.select(*COLUMNS).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def table(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, 7, 0.5) for i, v in vectors], f"vec_id long, embedding array<{kind}>, rank int, score double")


def test_query_equals_its_sql(spark, sf_dir, con):
    got = rows_of(QUERIES["op13_exact_topk"](spark, sf_dir))
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLES['op13_exact_topk']})").fetchall()
    assert got == set(want) and len(want) == len(got) > 0


@pytest.mark.parametrize("shard_rows,block", [(10 ** 6, 2048), (17, 3)])
def test_many_shards_ties_and_copies(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(ball_tree, "QUERY_BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = {i: rng.integers(-3, 4, 4) for i in range(300)}      # many ties
    vectors |= {i: np.array([2, 2, 2, 2]) for i in range(300, 420)}                     # a third of copies
    df = table(spark, [(i, (v / 8).tolist()) for i, v in vectors.items()])
    want = {i: (v * 128).tolist() for i, v in vectors.items()}
    assert rows_of(ball_tree.exact_top_k(df, 20, 7, shard_rows=shard_rows, leaf_rows=4)) == brute(want, 20, 7)


def test_rows_that_take_no_part_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.1, -0.2]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, []), (7, [1.0]), (None, [1.0, 1.0]), (8, [0.0, 0.0]), (9, [-0.0004, 0.0]), (1, [0.3, 0.3])]
    want = {0: [1024, 512], 1: [102, -205], 8: [0, 0], 9: [-1, 0]}
    assert rows_of(ball_tree.exact_top_k(table(spark, rows), 1, 10)) == brute(want, 1, 10)
    assert ball_tree.exact_top_k(table(spark, rows).where("false"), 1, 10).columns == COLUMNS
    assert ball_tree.exact_top_k(table(spark, rows).where("vec_id = 2"), 1, 10).count() == 0
    assert ball_tree.exact_top_k(table(spark, [(0, [1.0])]), 1, 10).count() == 0


def test_scores_beyond_doubles_stay_exact(spark):
    big = float(2 ** 20)
    rows = [(i, [big + i, -big, 1.0 + i / 1024]) for i in range(30)]
    want = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    assert max(s for *_, s in brute(want, 1, 1)) > 1 << 60
    assert rows_of(ball_tree.exact_top_k(table(spark, rows, "double"), 3, 5, shard_rows=8, leaf_rows=2)) == brute(want, 3, 5)
    huge = rows_of(ball_tree.exact_top_k(table(spark, [(0, [1e30]), (1, [1e30]), (2, [-1e30])], "double"), 1, 5))
    top = (1 << 63) - 1
    assert {(q, v, s) for q, _, v, s in huge if q == 0} == {(0, 1, top), (0, 2, -top - 1)}


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(20, 8)) * 4000
    rows = (centers[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 100).astype(np.int64)
    tree = ball_tree.BallTree.grow(np.arange(4000), rows)
    queries = rows[:50]
    bounds, scores = tree.bounds(queries), queries @ tree.vectors.T
    for n, (start, end, *_) in enumerate(tree.nodes):
        assert (scores[:, start:end].max(axis=1) <= bounds[:, n]).all()
    opened, plain = [], tree.scores
    tree.scores = lambda q, a, b: (opened.append(b - a), plain(q, a, b))[1]
    for own, (q, bound) in enumerate(zip(queries, bounds)):
        ids, found = tree.search(own, q, bound, 10, None)
        order = np.lexsort((tree.ids, -scores[own]))
        assert ids.tolist() == [i for i in tree.ids[order].tolist() if i != own][:10]
    assert sum(opened) < 0.3 * 50 * 4000                           # most rows are never scored
