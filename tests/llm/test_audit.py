"""Source divergence audit: SQL, a plain Python audit, the sparse merge and exact prices."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import divergence
from kestrel.llm.queries import ORACLES, QUERIES


def plain_audit(rows, least, top):
    """Rows of (text, lang, source), counted and priced one by one."""
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        docs[lang].update(set(terms))
        count[lang, source].update(terms)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def price(n, total, v=len(kept)):
            return 1 + floor(Fraction(10 ** 9 * (n + 5), total + 5 * v))
        p = {s: {t: price(count[lang, s][t], sum(count[lang, s][k] for k in kept)) for t in kept} for s in sources}
        every = sum((count[lang, s] for s in sources), Counter())
        q = {t: price(every[t], sum(every[k] for k in kept)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def rows_of(df):
    got = df.select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


ROWS = [("the Cat sat on the mat", "en", "a"), ("the dog's Äpfel, äpfel", "en", "b"), ("THE CAT; the end", "en", "c"),
        ("the cat", "en", "a"), ("the cat", "en", "a"), (None, "en", "silent"), ("123 456", "en", "digits"), ("", None, None),
        ("le chat et le chien", "fr", "a"), ("le 漢字 chat", "fr", None), (None, None, "x"), ("solo", "xx", "only"),
        ("x" * 5000 + " the", "en", "b"), ("naïve Éa éa", "fr", "a")]


@pytest.mark.parametrize("least,blocks", [(1, 3), (2, 10 ** 6), (99, 5)])
def test_audit_equals_the_plain_one(spark, least, blocks):
    df = spark.createDataFrame([(*r, 1, "clash", 2) for r in ROWS], "text string, lang string, source string, n long, term string, value int")
    got = divergence.audit_sources(df, least_docs=least, top_terms=3, block_terms=blocks)
    assert rows_of(got) == plain_audit(ROWS, least, 3)


def test_query_equals_its_sql(spark, sf_dir, con):
    got = rows_of(QUERIES["op11_source_audit"](spark, sf_dir))
    want = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({ORACLES['op11_source_audit']})").fetchall()
    assert got == set(want) and len(want) == len(set(want)) > 1000


def test_empty_table_and_long_texts(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit_sources(spark.createDataFrame([], schema)).count() == 0
    rows = [("word other " * 3000 + str(k), "en", f"s{k % 2}") for k in range(4)]
    cut = divergence.term_counts(spark.createDataFrame(rows, schema), slice_bytes=1000)      # every text is a long one
    assert {tuple(r) for r in cut.collect()} == {("en", s, t, 0 if t is None else 6000 if s else 4)
                                                 for s in ("s0", "s1", None) for t in ("word", "other", None)}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 12), st.integers(0, 10 ** 14), st.integers(1, 10 ** 7))
def test_prices_are_exact(count, rest, kept):
    assert int(divergence.prices(count, count + rest, kept)) == 1 + floor(
        Fraction(10 ** 9 * (count + 5), count + rest + 5 * kept))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2000)), st.sets(st.integers(0, 2000)))
def test_galloping_merge(a, b):
    ids_a, ids_b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    assert divergence.galloping_bounds(ids_a, ids_b).tolist() == np.searchsorted(ids_b, ids_a).tolist()
    n_a, n_b = ids_a % 7 + 1, ids_b % 5 + 1
    held, value = divergence.merge_pair(ids_a, n_a, int(n_a.sum()), ids_b, n_b, int(n_b.sum()), 2001)
    x, y = dict(zip(ids_a.tolist(), n_a)), dict(zip(ids_b.tolist(), n_b))
    assert held == len(a | b)
    assert value == sum(abs(int(divergence.prices(x.get(t, 0), int(n_a.sum()), 2001))
                            - int(divergence.prices(y.get(t, 0), int(n_b.sum()), 2001))) for t in a | b)
