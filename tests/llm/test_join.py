"""N-gram join: against brute force on whole texts, hard groups, components and edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from kestrel.llm import ngram_join
from kestrel.llm.components import connected_components
from kestrel.llm.queries import QUERIES

UPPER = {i: i + 32 for i in range(65, 91)}


def shingles(t, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
    if len(w) >= n:
        return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(texts):
    """(sizes, component per id) of {id: text}."""
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    holders = {}
    for d, s in sorted(sets.items()):
        met = Counter(e for g in s for e in holders.get(g, ()))
        for e, k in met.items():
            if 100 * k >= 75 * (len(s) + len(sets[e]) - k):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
        for g in s:
            holders.setdefault(g, []).append(d)
    return {d: len(s) for d, s in sets.items()}, {d: find(d) for d in sets}


def check(rows, texts):
    sizes, component = brute(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == {d: (sizes[d], component[d]) for d in texts}


def test_op10_equals_brute_force_on_whole_texts(spark, sf_dir, texts):
    check(QUERIES["op10_ngram_join"](spark, sf_dir).collect(), texts)


def near_copies(seed, groups, sizes, words, edits):
    """Groups of edited copies around the threshold, with passages shared across groups."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passages = [" ".join(r.choices(vocabulary, k=12)) for _ in range(3)]
    out = []
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.choice(words))
        for _ in range(r.choice(sizes)):
            t = list(base)
            for _ in range(r.randint(0, edits)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            text = " ".join(t)
            if r.random() < 0.5:
                text = r.choice(passages) + " " + text
            out.append(text.upper() if r.random() < 0.1 else text)
    r.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_around_the_threshold(spark, seed):
    texts = near_copies(seed, 40, [1, 2, 5, 12], [4, 5, 8, 30, 80], 5)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(ngram_join.ngram_components(df.repartition(5)).collect(), texts)


def test_large_group_of_chained_copies_goes_through_the_residual(spark, monkeypatch):
    """Copies drift along a chain: ends are far apart, neighbours are linked, n-grams have many sharers."""
    monkeypatch.setattr(ngram_join, "SMALL_RUN", 3)
    monkeypatch.setattr(ngram_join, "BRANCH_GRAMS", 700)
    r = random.Random(4)
    words = [f"c{i}" for i in range(60)]
    texts = {}
    for d in range(150):
        texts[d] = " ".join(words)
        words = words[1:] + [f"n{d}"] if d % 3 == 0 else words
    texts.update({1000 + i: " ".join(r.choices([f"z{j}" for j in range(9)], k=40)) for i in range(60)})
    texts.update({2000 + i: "license text shared by all of these documents in one long common line " * 2 + f"tail{i} a{i} b{i}"
                  for i in range(40)})
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(ngram_join.ngram_components(df.repartition(4)).collect(), texts)


def linked(a, b):
    return 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))


def test_trie_join_equals_plain_intersections():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = np.unique(rng.integers(0, 400, rng.choice([3, 120]), dtype=np.uint64))
        sets = []
        for _ in range(24):
            s = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])]
            sets.append(np.unique(np.concatenate((s, rng.integers(0, 400, rng.integers(1, 12), dtype=np.uint64)))))
        build, probes = sets[:14], sets[9:]
        want = {(i, j) for i, a in enumerate(build) for j, b in enumerate(probes) if linked(a, b)}
        for step, at_once in ((1, 3), (5, 100), (128, 256)):
            found = ngram_join.trie_join(build, probes, step, at_once)
            assert {(i, int(j)) for i, js in found for j in js} == want


def test_a_task_emits_what_its_links_connect():
    rng = np.random.default_rng(7)
    base = np.arange(200, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(200) > 0.12], np.array([1000 + k], np.uint64)))) for k in range(60)]
    sides = [int(x) for x in rng.integers(0, 3, 60)]
    reps = list(range(100, 160))
    out = ngram_join._connected(sides, reps, sets)
    joined = ngram_join._Joined()
    for a in range(60):
        for b in range(60):
            if a != b and sides[a] != 1 and sides[b] != 0 and linked(sets[a], sets[b]):
                joined.join(reps[a], reps[b])
    assert sorted(out) == sorted((joined.find(r), r) for r in reps if joined.find(r) != r)
    assert len(out) > 5 and ngram_join._connected([0, 0], [1, 2], sets[:2]) == []


@pytest.mark.parametrize("grams", [1 << 19, 4000])
def test_thousands_of_near_copies_that_are_not_linked(spark, monkeypatch, grams):
    """All share a half of their words, few pairs are linked; rows that leave the tasks stay few."""
    monkeypatch.setattr(ngram_join, "BRANCH_GRAMS", grams)
    r = random.Random(9)
    n = 2500 if grams > 4000 else 300
    core = [f"c{i}" for i in range(40)]
    texts = {d: " ".join(core + [f"t{r.randrange(10 ** 9)}" for _ in range(30)]) for d in range(n)}
    texts |= {10_000 + k: texts[7 * k] + " more" for k in range(20)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    join = ngram_join.NgramJoin(df)
    got = {m.doc_id: m.component_id for m in join.memberships().collect()}
    assert got == {d: 7 * (d - 10_000) if d >= 10_000 else d for d in texts}


def test_fronts_of_linked_sets_share_enough():
    rng = np.random.default_rng(1)
    for _ in range(500):
        a = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 200), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > 0.15], rng.integers(0, 2 ** 63, rng.integers(0, 20), dtype=np.uint64))))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 75 * (len(a) + len(b) - common):
            hot = np.sort(ngram_join._gram_ids(rng.choice(a, len(a) // 3, replace=False), 8))
            fa, fb = (ngram_join._ordered(s, hot, 8)[:ngram_join.front_length(len(s))] for s in (a, b))
            assert len(np.intersect1d(fa, fb)) >= ngram_join._least_shared(min(len(a), len(b)))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (300, 299)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in connected_components(spark, df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}
    assert connected_components(spark, df.where("false")).count() == 0


def test_odd_rows_have_defined_results(odd, empty):
    rows = ngram_join.ngram_components(odd).collect()
    assert len(rows) == odd.count()
    assert sorted((r.n_shingles, r.component_id) for r in rows if r.doc_id == 1) == [(7, 1), (7, 1)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert {(r.doc_id, r.component_id) for r in rows if r.n_shingles == 0} == {(2, 2), (3, 3), (5, 5)}
    assert ngram_join.ngram_components(empty).count() == 0


def test_one_document_of_each_group_stays(spark, odd, empty):
    same = "a b c d e f g h i j"
    df = spark.createDataFrame([(5, same, 1), (3, same, 2), (9, same + " k", 3), (4, "x y z", 4), (3, same, 5), (None, same, 6), (8, None, 7)],
                               "doc_id long, text string, rows int")
    kept = ngram_join.keep_one_per_component(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 3), (False, 4), (False, 8), (True, None)]
    assert ngram_join.keep_one_per_component(empty).count() == 0
    assert {r.doc_id for r in ngram_join.keep_one_per_component(odd).collect()} >= {1, 2, 3, 4, 5, 6, 7, None}


def test_each_text_of_a_repeated_id_keeps_its_own_links(spark):
    """Ids 1 and 4 stand for two sets each; 6 and 7 are near copies of one text of id 1 and of id 4."""
    r = random.Random(3)
    a, b, c, d = (" ".join(f"{p}{r.randrange(10 ** 6)}" for _ in range(60)) for p in "abcd")
    rows = [(1, a), (1, b), (5, a + " x"), (6, b + " y"), (4, c), (4, d), (7, c + " z"), (8, d + " z"), (9, None), (9, a + " v"),
            (10, None), (10, "alone in all of this table")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(m.doc_id, m.n_shingles): m.component_id for m in ngram_join.ngram_components(df).collect() if m.doc_id > 4}
    assert got == {(5, 57): 1, (6, 57): 1, (7, 57): 4, (8, 57): 4, (9, 0): 9, (9, 57): 1, (10, 0): 10, (10, 2): 10}
    kept = ngram_join.keep_one_per_component(df)
    assert kept.columns == df.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [
        (1, a), (1, b), (4, c), (4, d), (9, None), (10, None), (10, "alone in all of this table")]))


def test_two_near_texts_of_one_id_leave_one(spark):
    same = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(2, same), (2, same + " x"), (2, same), (None, same), (3, same + " y")], "doc_id long, text string")
    assert sorted(str(k.doc_id) for k in ngram_join.keep_one_per_component(df).collect()) == ["2", "None"]
