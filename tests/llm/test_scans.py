"""Secrets, personal data and quality rules: against plain Python on whole texts."""

import hashlib
import random
import re
import string
from collections import Counter

import pytest

from kestrel.llm import pii, quality_rules, secret_scan
from kestrel.llm.queries import ORACLES, QUERIES


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---------------------------------------------------------------- secrets
def brute_secrets(t):
    out = [("assign", m.start(), m.end()) for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t)
        if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def test_op5_base_spans_equal_brute_force(spark, sf_dir, texts):
    for r in QUERIES["op5_secret_scan"](spark, sf_dir).collect():
        want = brute_secrets(texts[r.doc_id])
        n = Counter(s[0] for s in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want))
        assert set(want) <= {(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)}


def test_secret_shapes_on_random_strings():
    r = random.Random(5)
    parts = ["password", "TOKEN", "Api_Key", "apikey", "toKen", "=", ":", " ", "  ", "'", '"', "abc123", "x", "AKIA", "Z" * 16,
             "0123456789abcdef", "deadbeef", "é", "\n", "ſecret", "tokeN = "]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert secret_scan.base_spans(t) == brute_secrets(t)


def test_token_efficiency_finds_random_strings_and_spares_the_known(spark):
    ef = secret_scan._efficiency("byte_bpe_50k.tiktoken")
    rnd = "zX9qLr7Tk2Vw8PbN4mYcQh6J"
    spared = ["d41d8cd98f00b204e9800998ecf8427e", "da39a3ee5e6b4b0d3255bfef95601890afd80709", "123e4567-e89b-12d3-a456-426614174000",
              "12345678901234567890", "internationalization", "the_quick_brown_fox_2", "D41D8CD98F00B204E9800998ECF8427E"]
    assert secret_scan.random_spans(f"key {rnd} end", ef, 1.9, []) == [("random", 4, 4 + len(rnd))]
    for s in spared:
        assert secret_scan.random_spans(f"a {s} b", ef, 1.9, []) == []
    taken = [("assign", 0, 40)]
    assert secret_scan.random_spans(f"key {rnd} end", ef, 1.9, taken) == []


def found(s):
    return secret_scan.random_spans(f"a {s} b", secret_scan._efficiency("byte_bpe_50k.tiktoken"), 1.9, []) == [("random", 2, 2 + len(s))]


def one_digit(r, n):
    at = r.randrange(n)
    return "".join(r.choice(string.digits if i == at else string.ascii_letters) for i in range(n))


@pytest.mark.parametrize("least, make", [
    (0.99, lambda r, n: "".join(r.choices(string.ascii_letters + string.digits, k=n))),
    (0.99, lambda r, n: "".join(r.choices(string.ascii_letters, k=n))), (0.99, one_digit),
    (0.95, lambda r, n: "".join(r.choices(string.ascii_uppercase, k=n))),
    (0.83, lambda r, n: "".join(r.choices(string.ascii_lowercase, k=n)))],
    ids=["base62", "letters", "one digit", "upper", "lower"])
@pytest.mark.parametrize("length", [16, 20, 32, 40])
def test_random_keys_are_found_whatever_their_classes(spark, least, make, length):
    r = random.Random(length)
    assert sum(found(make(r, length)) for _ in range(500)) >= least * 500


def test_names_numbers_and_rules_are_spared(spark):
    names = ["getElementsByTagNameFromDocument", "AbstractSingletonProxyFactoryBean", "HTTPSConnectionPoolManager",
             "org_apache_spark_sql_catalyst", "max_connections_per_host_2", "MAX_RETRY_COUNT_EXCEEDED", "RESPONSE_JOB_RENDER_CHILD",
             "MESSAGE_LOCAL_COUNT_POOL", "/usr/local/lib/python3/site-packages", "parse-utf8-string-2024"]
    others = ["2024-01-01_12-30-00", "20240101T123000Z", "0049-89-1234567890", "4111-1111-1111-1111", "-=-=-=-=-=-=-=-=-=",
              "+--+---+-+----+--+", "================"]
    assert [s for s in names + others if found(s)] == []
    assert secret_scan.is_identifier("RESPONSE_JOB_RENDER_CHILD", secret_scan._efficiency("byte_bpe_50k.tiktoken"))


def test_secrets_of_odd_rows(odd, empty):
    rows = secret_scan.scan_secrets(odd).collect()
    assert len(rows) == odd.count()
    assert {r.base_sha256 for r in rows} == {sha("")} and {r.spans for r in rows} == {""}
    assert secret_scan.scan_secrets(empty).count() == 0


# ---------------------------------------------------------------- personal data
SHAPES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute_pii(t):
    return [(k, m.start(), m.end()) for k in SHAPES for m in re.finditer(SHAPES[k], t) if passes(k, m[0])]


def assert_base(rows, texts):
    for r in rows:
        want = brute_pii(texts[r.doc_id])
        n = Counter(s[0] for s in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in SHAPES)
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in want)), texts[r.doc_id][:200]


def test_op3_base_spans_equal_brute_force(spark, sf_dir, texts):
    rows = QUERIES["op3_pii"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    assert_base(rows, texts)


def test_pii_shapes_on_random_and_hard_strings(spark):
    r = random.Random(3)
    parts = ["a", ".", "@", "1", "2.", "255.", "é", "😀", " ", "-", "+1 (", "4", ")", "b.c", "_", "%", "\n",
             "4000123412341234", "1.2.3.4", "x@y.z", "007", "000300", "4111 1111 1111 1111"]
    own = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(600)]
    own += ["", "1" * 2000 + ".1.1.1", "a" * 2000 + "@", "4111 1111 1111 1111x" * 300, "a@b.c.@d.e", "a@b.c_d@e.f"]
    df = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    assert_base(pii.find_pii(df).collect(), dict(enumerate(own)))


def test_patterns_learned_from_seeds_find_unseen_identifiers(spark):
    seeds = [f"please ring phone: +1 (555) 010-0{i:03d} today" for i in range(30)]
    seeds += [f"the case {i} is closed and the file {i} too" for i in range(30)]
    unseen = ["please ring phone: 555-0199-22 today", "the ref 555-0199-23 is of no use"]
    df = spark.createDataFrame(list(enumerate(seeds + unseen)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert got[60].spans == "context:19:30" and got[60].n_context == 1 and got[60].base_sha256 == sha("")
    assert got[61].n_context == 0 and all(got[i].n_context == 0 for i in range(30, 60))
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[60] == "please ring phone: <CONTEXT> today" and clean[0] == "please ring phone: <PHONE> today"
    assert clean[61] == unseen[1]


def test_redaction_merges_overlaps_and_keeps_the_rest(spark):
    own = ["x é😀 a@b.co, 10.0.0.1 and 4111111111111111.", "+1 4111 1111 1111 11 11", None, "", "nothing here"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(own)], "doc_id long, text string, email int")
    out = pii.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "x é😀 <EMAIL>, <IP> and <CARD>." and got[2] is None and got[3] == "" and got[4] == own[4]
    spans = sorted((a, b) for _, a, b in brute_pii(own[1]))
    assert ("<" in got[1]) == bool(spans)


def plain_tokens(t):
    """(token, start, end, words ahead, is a seed) of a text, by plain string work."""
    base = sorted((a, b, t[a:b]) for _, a, b in brute_pii(t))
    out = []
    for m in re.finditer(r"\S+", t):
        if not re.search("[0-9@]", m[0]):
            continue
        ahead = t[:m.start()].lower().split()
        # words behind the token before this one
        before = [w for w in re.split(r"\s+", t[:m.start()].lower()) if w]
        free = []
        for w in reversed(before):
            if re.search("[0-9@]", w):
                break
            free.insert(0, w)
        del ahead
        one = free[-1] if free and re.search(r"[^\W\d_]", free[-1]) else None
        two = f"{free[-2]} {free[-1]}" if one and len(free) > 1 else None
        punct = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"
        lead = len(re.match(f"[{punct}]*", re.sub("[+@]", "x", m[0]))[0])
        bare = re.sub(f"[{punct}]+$", "", m[0][lead:]) if re.search(f"[^{punct}]", m[0][lead:]) else m[0][lead:]
        touching = [x for x in base if x[0] < m.end() and m.start() < x[1]]
        out.append((touching[0][2] if touching else bare, m.start() + lead, m.start() + lead + len(bare), one, two, bool(touching)))
    return out


def plain_context(texts, b=pii.Bootstrap()):
    """Context spans per text, by a bootstrap over plain dictionaries."""
    found = {d: plain_tokens(t) for d, t in texts.items()}
    edges, seed_of = Counter(), {}
    for rows in found.values():
        for token, _, _, one, two, seed in rows:
            for p in (one, two):
                if p:
                    edges[p, token] += 1
                    seed_of[p, token] = seed_of.get((p, token), False) or seed
    seeded = {p for p, n in Counter(p for (p, _), s in seed_of.items() if s).items() if n >= b.min_seeds}
    total = Counter()
    for t in texts.values():
        if re.search("[0-9@]", t):
            w = re.split(r"\s+", t.lower())
            total.update(x for x in [*w, *(f"{x} {y}" for x, y in zip(w, w[1:]))] if x in seeded)
    score, sure = {}, {}
    for _ in range(b.rounds):
        good = Counter()
        for (p, token), n in edges.items():
            if p in seeded:
                good[p] += n * (1.0 if seed_of[p, token] else score.get(token, 0.0))
        sure = {p: c for p in seeded if (c := min(1.0, good[p] / total[p])) >= b.min_confidence}
        score = {}
        for (p, token) in edges:
            if p in sure and not seed_of[p, token]:
                score[token] = 1 - (1 - score.get(token, 0.0)) * max(1e-9, 1 - sure[p])
    return {d: sorted({(s, e) for token, s, e, one, two, seed in rows if not seed and len(token) >= b.min_length
                       and score.get(token, 0) >= b.min_score and (one in sure or two in sure)}) for d, rows in found.items()}


def test_context_spans_equal_a_plain_bootstrap(spark):
    r = random.Random(8)
    mail, ring = (lambda k: f"user{k}@mail.org"), (lambda k: f"+1 (555) 01{k % 10}-{1000 + k}")
    texts = {}
    for k in range(120):
        kind = k % 6
        texts[k] = ["contact {} soon", "our desk line {} today", "case {} closed", "reach me via mail {}, thanks", "line {} of code",
                    "the\t\n  desk   line {} rings"][kind].format(
            [mail(k), ring(k), str(1000 + k), mail(k), str(k), r.choice([ring(k), f"ext-{4000 + k}"])][kind])
    texts |= {200: "contact bob#77345 soon", 201: "a desk line 555-0199 is free", 202: "line 88123 of code",
              203: "via mail joe(at)host9, and contact x1x2x3 " + " " * 200 + "contact" + " " * 90 + "far#99001",
              204: "contact a@b.co;10.20.30.40 desk line +44 20 7946 0958 9", 205: "w" * 70 + " 12345", 206: ""}
    got = {x.doc_id: x for x in pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    want = plain_context(texts)
    assert {d: [s for s in x.spans.split(",") if s.startswith("context")] for d, x in got.items()} == {
        d: [f"context:{a}:{b}" for a, b in spans] for d, spans in want.items()}
    assert want[200] and want[201] and len(want[203]) >= 2 and not want[205]


def test_a_megabyte_of_identifiers_ends_in_seconds(spark):
    import time
    r = random.Random(1)
    text = " ".join(r.choice(["mail a{0}@b.org", "ip 10.0.{1}.{2}", "id {0}", "x{0}"]).format(k, k % 256, k % 99) for k in range(60_000))
    df = spark.createDataFrame([(0, text), (1, "mail none"), (2, "y" * 1_000_000)], "doc_id long, text string")
    assert len(text) > 700_000
    start = time.time()
    rows = {x.doc_id: x for x in pii.find_pii(df).collect()}
    assert rows[0].n_email + rows[0].n_ip > 20_000 and rows[2].spans == ""
    clean = {x.doc_id: x.text for x in pii.redact(df).collect()}
    assert time.time() - start < 120
    spans, out, at = sorted((a, b, k) for k, a, b in brute_pii(text)), [], 0
    context = [tuple(map(int, s.split(":")[1:])) for s in rows[0].spans.split(",") if s.startswith("context")]
    for a, b, k in sorted([*spans, *((a, b, "context") for a, b in context)]):
        if a >= at:
            out += [text[at:a], f"<{k.upper()}>"]
        at = max(at, b)
    assert clean[0] == "".join(out) + text[at:] and clean[2] == "y" * 1_000_000


def test_pii_of_odd_rows(odd, empty):
    rows = pii.find_pii(odd).collect()
    assert len(rows) == odd.count() and {r.spans for r in rows} == {""}
    assert sorted(map(str, pii.redact(odd).collect())) == sorted(map(str, odd.collect()))
    assert pii.find_pii(empty).count() == 0 and pii.redact(empty).count() == 0


def test_pii_runs_without_python_on_executors(documents):
    plan = pii.find_pii(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- quality
def test_op9_matches_its_sql(spark, sf_dir, con):
    df = QUERIES["op9_quality_rules"](spark, sf_dir)
    r = con.execute(ORACLES["op9_quality_rules"])
    names = [d[0] for d in r.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(r.fetchall())


def brute_quality(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), len(lines))


def test_measures_on_random_texts_and_slices(spark):
    r = random.Random(9)
    parts = ["a", "b", "é", "😀", " ", " ", "\n", "\t", "\x0b", "#", "|", "\xa0", "ab"]
    own = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(1500)] + [None, "", "\n\n", "a " * 5000]
    df = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    for size in (200, 1 << 20):
        for x in quality_rules.measure(df, slice_bytes=size).collect():
            assert tuple(x[1:]) == brute_quality(own[x.doc_id] or ""), repr(own[x.doc_id])[:200]


def test_policies_and_ablation_agree_with_recounting(documents):
    rows = quality_rules.ledger(documents)
    data = rows.collect()
    for policy in quality_rules.POLICIES:
        mask = quality_rules.policy_mask(policy)
        kept = quality_rules.apply_policy(rows, policy).collect()
        assert all(r.kept == (r.failures & mask == 0) for r in kept)
        for a in quality_rules.ablation(rows, policy).collect():
            bit = next(1 << r.bit for r in quality_rules.RULES if r.name == a.rule)
            own = [r.failures & mask for r in data]
            assert a.rejected == sum(bool(f & bit) for f in own)
            assert a.rejected_alone == sum(f == bit for f in own)
            assert a.kept_without == sum(f & ~bit == 0 for f in own)


def test_ablation_query_matches_its_sql(spark, sf_dir, con):
    df = QUERIES["quality_ablation"](spark, sf_dir)
    r = con.execute(ORACLES["quality_ablation"])
    names = [d[0] for d in r.description]
    want = sorted(r.fetchall())
    assert sorted(map(tuple, df.select(*names).collect())) == want and len(want) == 13


def test_quality_of_odd_rows(odd, empty):
    rows = quality_rules.ledger(odd).collect()
    assert len(rows) == odd.count() and all(r.failures & 1 for r in rows if r.n_words == 0)
    assert quality_rules.ledger(empty).count() == 0


@pytest.mark.parametrize("length", [70_000, 200_000])
def test_hashes_tell_very_long_words_apart(spark, length):
    a, b = "x" * length, "x" * (length - 1) + "y"
    df = spark.createDataFrame([(0, f"{a}\n{b}\n{a}")], "doc_id long, text string")
    r = quality_rules.measure(df).first()
    assert (r.n_words, r.n_dup_lines) == (3, 1)
