"""Cross-tokenizer alignment against the two libraries on whole texts and plain counting."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from kestrel.llm import alignment
from kestrel.llm.queries import QUERIES
from kestrel.llm.tables import tokenizer_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a", " ", "  ", "\n", "é", "▁", "漢", "<|endoftext|>", "</s>", "the", " of", ".", "1", "😀", "\x00", "　", "\x1c", " _", "'s",
       "\u0085x", " ", "​", " \t", "ﬁ", "<0x0A>", "ing", "A"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(tokenizer_file(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B))


def plain_bytes_a(tok):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, k = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + k)] = b
            k += 1
    return {i: bytes(table[c] for c in t) for t, i in tok.get_vocab(with_added_tokens=False).items()}


def plain(texts, libraries):
    """Groups and links per text, from whole-text encodings."""
    tok, sp = libraries
    of_a = plain_bytes_a(tok)
    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        a = tok.encode(" " + t, add_special_tokens=False).ids
        b = sp.encode(t)
        parts_a = [of_a[i] for i in a]
        parts_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b, sp.id_to_piece(b))]
        if not b"".join(parts_a) == b"".join(parts_b) == (" " + t).encode():
            out.append(None)
            continue
        ends = []
        for parts in (parts_a, parts_b):
            n, own = 0, []
            for p in parts:
                n += len(p)
                own.append(n)
            ends.append(own)
        both = set(ends[0]) & set(ends[1])
        links = list(zip(*([i for i, e in zip(ids, own) if e in both] for ids, own in ((a, ends[0]), (b, ends[1])))))
        sides = []
        for ids, own in ((a, ends[0]), (b, ends[1])):
            groups = [[]]
            for i, e in zip(ids, own):
                groups[-1].append(str(i))
                if e in both:
                    groups.append([])
            sides.append([",".join(g) for g in groups[:-1]])
        groups = ["|".join(g) for g in zip(*sides)]
        out.append((len(a), len(b), groups, links))
    return out


def expected(texts, libraries):
    found = plain(texts, libraries)
    count = Counter(x for f in found if f for x in f[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    return [(0, 0, 0, 0, 0, 0, "") if not f else
            (f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


def test_stretches_give_the_tokens_of_whole_texts(libraries):
    r = random.Random(3)
    texts = ["".join(r.choice(ODD) for _ in range(r.randint(0, 25))) for _ in range(1500)]
    al = alignment.aligner(A, B)
    assert al.by_stretch
    for t, (n_a, n_b, n_groups, written, packed), want in zip(texts, al.documents(texts), plain(texts, libraries)):
        assert (n_a, n_b, n_groups, written) == ((want[0], want[1], len(want[2]), ";".join(want[2])) if want else (0, 0, 0, "")), t
        assert len(packed) // al.code.itemsize == (len(want[3]) if want else 0)


def test_query_equals_plain_counting(spark, sf_dir, texts, libraries):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_token_alignment"](spark, sf_dir).collect()}
    ids = sorted(texts)
    assert [got[i] for i in ids] == expected([texts[i] for i in ids], libraries) and len(got) == len(ids)


def test_odd_rows(spark, odd, empty, libraries):
    rows = odd.select("doc_id", "text").collect()
    rows.append((8, "a▁b"))
    df = odd.unionByName(spark.createDataFrame([(8, "a▁b")], "doc_id long, text string"), allowMissingColumns=True)
    got = alignment.align_tokenizers(df.withColumnRenamed("spans", "links"), A, B, slice_bytes=2000)
    want = expected([r[1] for r in rows], libraries)
    assert Counter(tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in got.collect()) == Counter(
        (r[0], *w) for r, w in zip(rows, want))
    assert alignment.align_tokenizers(empty, A, B).count() == 0


def test_tokens_without_bytes_link_with_the_token_before_them():
    groups, links = alignment.align([1, 2, 3], [2, 0, 1], [7, 8, 9], [1, 1, 1])
    assert groups == [([1, 2], [7, 8]), ([3], [9])]
    assert sorted(links) == [(1, 8), (2, 8), (3, 9)]


def test_memo_is_bounded_by_bytes_and_never_changes_results(monkeypatch, libraries):
    al = alignment.Aligner(tokenizer_file(A), tokenizer_file(B))
    texts = [f"word{k} other{k} words" for k in range(50)]
    want = list(al.documents(texts))
    monkeypatch.setattr(alignment, "MEMO_BYTES", 5000)
    small = alignment.Aligner(tokenizer_file(A), tokenizer_file(B))
    assert [x for t in texts for x in small.documents([t])] == want
    assert len(small._held) < 15


def test_linked_pairs_are_bounded_by_the_vocabularies(spark, documents):
    al = alignment.aligner(A, B)
    bound = alignment.possible_pairs(al.bytes_a, al.bytes_b)
    assert bound < 2_000_000
    pairs = alignment.pair_counts(alignment.aligned_documents(documents, A, B), al.code.str, len(al.bytes_b))
    for r in pairs.limit(5000).collect():
        a, b = al.bytes_a[r.a], al.bytes_b[r.b]
        assert a.endswith(b) or b.endswith(a)
