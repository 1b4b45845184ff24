"""Mixing, toxicity and nearest neighbours: statistics, held-out accuracy and brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kestrel.llm import ann, mixing, toxicity
from kestrel.llm.crf import ChainCRF
from kestrel.llm.queries import ORACLES, QUERIES


# ---------------------------------------------------------------- mixing
def test_op1_matches_its_sql(spark, sf_dir, con):
    df = QUERIES["op1_mix_sources"](spark, sf_dir)
    r = con.execute(ORACLES["op1_mix_sources"])
    names = [d[0] for d in r.description]
    got, want = sorted(map(tuple, df.select(*names).collect())), sorted(r.fetchall())
    assert len(got) == len(want)
    rate = names.index("rate")
    for g, w in zip(got, want):
        assert g[:rate] + g[rate + 1:] == w[:rate] + w[rate + 1:] and math.isclose(g[rate], w[rate], rel_tol=1e-12)


def test_mixing_reaches_the_target_weights(spark):
    df = spark.range(40_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'big' WHEN id % 3 = 1 THEN 'mid' ELSE 'small' END AS source",
                                        "repeat('x', CASE WHEN id % 3 = 2 THEN 2 ELSE 10 END) AS text")
    out = mixing.mix(df, {"big": 1.0, "mid": 2.0, "small": 3.0}, seed=4)
    chars = {r["source"]: r["count"] * (2 if r["source"] == "small" else 10) for r in out.groupBy("source").count().collect()}
    total = sum(chars.values())
    for s, w in (("big", 1), ("mid", 2), ("small", 3)):
        assert abs(chars[s] / total - w / 6) < 0.01
    per = Counter(r.copies for r in out.where("source = 'mid' AND copy_no = 1").collect())
    rate = out.where("source = 'mid'").first().rate
    n = df.where("source = 'mid'").count()
    for k in range(1, 4):                                          # Poisson shares
        want = n * math.exp(-rate) * rate ** k / math.factorial(k)
        assert abs(per[k] - want) < 5 * math.sqrt(want) + 5


def test_large_rates_are_sums_of_draws(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "if(id < 20, 'rare', 'rest') AS source", "'xxxx' AS text")
    out = mixing.mix(df, {"rare": 1.0, "rest": 1.0}, seed=1)
    assert out.where("source = 'rare'").first().rate == pytest.approx(50.0)
    n = out.where("source = 'rare'").count()
    assert abs(n - 1000) < 5 * math.sqrt(1000)


def test_mixing_is_repeatable_shuffled_and_native(spark, documents):
    a = [tuple(r) for r in mixing.mix(documents, seed=3).select("doc_id", "copy_no", "shuffle_key").collect()]
    assert sorted(a) == sorted(tuple(r) for r in mixing.mix(documents.repartition(7), seed=3).select(
        "doc_id", "copy_no", "shuffle_key").collect())
    assert a != sorted(a) and len(set(a)) == len(a)
    assert sorted(a) != sorted(tuple(r) for r in mixing.mix(documents, seed=4).select("doc_id", "copy_no", "shuffle_key").collect())
    assert not re.search("Python|Pandas|Arrow", mixing.mix(documents)._jdf.queryExecution().executedPlan().toString())


def test_many_sources_are_joined_by_salt_with_the_same_result(documents, monkeypatch):
    columns = ["doc_id", "copy_no", "copies", "rate", "shuffle_key"]
    a = sorted(map(tuple, mixing.mix(documents, seed=3).select(*columns).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(documents, seed=3).select(*columns).collect())) == a


def test_mixing_odd_rows(odd, empty):
    out = mixing.mix(odd, epochs=40.0, seed=2)
    assert set(odd.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    rows = out.collect()
    assert any(r.doc_id is None for r in rows) and {r.source for r in rows} >= {"a", "b", "c"}
    assert all(r.copies >= r.copy_no >= 1 for r in rows)
    assert mixing.mix(empty).count() == 0
    sizes = {r.source: r.rate for r in mixing.source_rates(odd, {"b": 0.0}).collect()}
    assert sizes["b"] == 0.0 and None in sizes


# ---------------------------------------------------------------- toxicity
def test_compressed_posterior_equals_forward_backward():
    rng = np.random.default_rng(0)
    for _ in range(100):
        c = ChainCRF(1)
        c.bias, c.start, c.trans = rng.normal() * 2, rng.normal(), rng.normal(size=(2, 2)) * 2
        t = int(rng.integers(1, 40))
        s = np.where(rng.random(t) < 0.3, rng.normal(size=t) * 4, 0.0)
        p, _, _ = c._marginals((c.bias + s)[None])
        at = np.flatnonzero(s)
        assert np.allclose(p[0][at], c.posterior(at, s[at], t), atol=1e-9)


def test_training_learns_a_planted_chain():
    rng = np.random.default_rng(1)
    tags = (rng.random((400, 12)) < 0.2).astype(float)
    features = np.where(rng.random((400, 12)) < 0.95, tags, 1 - tags).astype(np.int64)[:, :, None]
    c = ChainCRF(2)
    c.fit(features, tags)
    p, _, _ = c._marginals(c.bias + c.weights[features[:, :, 0]])
    assert ((p > 0.5) == (tags > 0.5)).mean() > 0.93


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.fit(spark, docs, labels)


def test_held_out_documents_are_told_apart(spark, fitted):
    docs, labels, model = fitted
    rows = toxicity.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len(held) > 50 and sum(r.predicted == r.toxic for r in held) / len(held) >= 0.95
    assert sum(r.predicted for r in rows if not r.toxic) == 0        # clean documents are left alone


def test_scores_use_the_text_alone_and_spans_point_at_words(spark, fitted):
    docs, _, model = fitted
    texts = {r.doc_id: r.text for r in docs.collect()}
    a = toxicity.score(docs, model).collect()
    b = {r.doc_id: r.score for r in toxicity.score(docs.selectExpr("doc_id", "text", "'zz' AS lang", "'s' AS source", "1 AS toxic"), model).collect()}
    for r in a:
        assert b[r.doc_id] == r.score
        for s in filter(None, r.toxic_spans.split(",")):
            x, y = map(int, s.split(":"))
            assert re.fullmatch(r"[^\s]+", texts[r.doc_id][x:y])


def test_drop_toxic_keeps_rows_whole(fitted):
    docs, _, model = fitted
    kept = toxicity.drop_toxic(docs, model)
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert kept.schema == docs.schema and bad
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in docs.collect() if r.doc_id not in bad)


def test_toxicity_odd_rows_and_missing_labels(spark, fitted, odd, empty):
    docs, labels, model = fitted
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(r.predicted == 0 for r in rows)
    assert toxicity.score(empty, model).count() == 0 and toxicity.drop_toxic(empty, model).count() == 0
    none = toxicity.fit(spark, docs, labels.where("false"))
    assert toxicity.score(docs, none).where("predicted = 1").count() == 0
    assert toxicity.drop_toxic(odd, none).count() == odd.count()


# ---------------------------------------------------------------- nearest neighbours
def brute(ids, x, every, k):
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            s = (x * x[i]).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
            out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_op8_recall_and_exact_scores(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    want = brute(e.vec_id.to_numpy(), np.stack(e.embedding.to_numpy()).astype(float), 20, 20)
    got = {}
    for r in QUERIES["op8_nearest"](spark, sf_dir).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hit = [len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]
    assert np.mean(hit) >= 0.9


def test_partial_search_reaches_recall_on_clusters(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 6000)] + 0.4 * rng.normal(size=(6000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, query_every=100, k=10, trees=12, leaf_rows=64, search_share=0.2, search_least=500).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(np.arange(6000), x.astype(float), 100, 10)
    assert np.mean([len(got[q] & {a for a, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_vectors_that_take_no_part_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0])] + [(i, [0.5, 0.5]) for i in range(100, 160)] + [
        (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, inf]), (5, [1.0]), (6, []), (None, [1.0, 1.0]), (7, [None, 1.0]), (9, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in ann.nearest(df, query_every=20, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == {0, 20, 100, 120, 140}
    assert got[0] == [9, 20, *range(100, 118)] and got[20][:2] == [9, 0]
    assert got[100] == [9, 0, 20, *range(101, 118)]                # 1.0, then ties of 0.5 by id
    assert len(got[140]) == 20 and 140 not in got[140]
    assert ann.nearest(df.where("false")).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(few).collect()] == [(0, 1, 1, 5.0)]
