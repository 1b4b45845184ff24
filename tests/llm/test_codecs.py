"""SentencePiece codec, token counts, chat formatting: against the libraries and exact round trips."""

import hashlib
import json
import os
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as schema
from tokenizers import Tokenizer

from kestrel.llm import chat_format, sentencepiece_codec, token_counts
from kestrel.llm.queries import ORACLES, QUERIES
from kestrel.llm.tables import tokenizer_file

MODEL, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"
ODD = ["a", " ", "  ", "\n", "é", "▁", "漢", "<s>", "</s>", "the", " of", ".", "1", "😀", "\x00", "　", "ﬁ", "①", "ａ", "A"]


def sha(x):
    return hashlib.sha256(x).hexdigest()


def sp():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(MODEL))


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_ids_equal_the_library_and_spans_cover_the_source():
    c, lib = sentencepiece_codec.codec(MODEL), sp()
    for t in random_texts(800):
        ids = c.encode([t])[0]
        assert ids.tolist() == lib.encode(t)
        raw = t.encode()
        begin, end = c.spans(raw, ids)
        if len(ids):
            assert begin[0] == 0 and end[-1] == len(raw) and (begin[1:] == end[:-1]).all()
            _, align = c.normalizer.normalize(raw)                  # the general way agrees
            edges = np.concatenate(([0], np.cumsum(c.sizes[ids])))
            assert np.array(align)[edges].tolist() == [*begin.tolist(), end[-1]]


def test_the_registered_model_has_no_character_map_as_the_readme_says():
    c = sentencepiece_codec.codec(MODEL)
    assert c.by_word and not c.normalizer.map
    with open(os.path.join(os.path.dirname(__file__), "..", "..", "README.md")) as f:
        row = next(line for line in f if line.startswith("| `op2_sentencepiece` | `sentencepiece_codec.py`"))
    assert "character map is empty" in row and "arithmetic on blanks" in row


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix,squeeze", [(False, True), (True, False), (True, True)])
def test_normaliser_equals_the_library(rule, prefix, squeeze):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True,
                                                remove_extra_whitespaces=squeeze)
    spec = schema.NormalizerSpec()
    spec.ParseFromString(lib.serialized_normalizer_spec())
    own = sentencepiece_codec.Normalizer(spec.precompiled_charsmap, prefix, squeeze, True, False)
    for t in random_texts(300, seed=2):
        raw = t.encode()
        out, source = own.normalize(raw)
        want, places = lib.normalize(t, with_offsets=True)
        at = [i for i in range(len(out)) if out[i] & 0xC0 != 0x80] + [len(out)]
        assert out.decode() == want
        assert [len(raw[:source[i]].decode(errors="ignore")) for i in at] == places


def test_op2_equals_the_library_on_whole_texts(spark, sf_dir, texts):
    lib, got = sp(), QUERIES["op2_sentencepiece"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(lib.decode(ids).encode()) and r.covered_bytes == r.n_bytes


def test_encode_decode_round_trip_and_odd_rows(spark, odd, empty):
    rows = odd.select("doc_id", "text").collect()
    coded = sentencepiece_codec.encode(odd, MODEL)
    assert coded.columns == ["doc_id", "ids", "span_begin", "span_end"]
    assert all(len(r.ids) == len(r.span_begin) == len(r.span_end) for r in coded.collect())
    back = sentencepiece_codec.decode(coded, MODEL).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r.doc_id or -1, r.text or "") for r in rows)
    digests = sentencepiece_codec.encode_decode_digests(odd, MODEL).collect()
    assert len(digests) == len(rows)
    assert {r.n_tokens for r in digests if r.n_bytes == 0} == {2}
    assert sentencepiece_codec.encode_decode_digests(empty, MODEL).count() == 0


def test_small_slices_change_nothing(odd):
    a = sentencepiece_codec.encode_decode_digests(odd, MODEL).collect()
    b = sentencepiece_codec.encode_decode_digests(odd, MODEL, slice_bytes=64).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


# ---------------------------------------------------------------- token counts
def test_op4_equals_the_library_on_whole_texts(spark, sf_dir, texts):
    tok = Tokenizer.from_file(tokenizer_file(WORDS))
    for r in QUERIES["op4_token_counts"](spark, sf_dir).collect():
        t = texts[r.doc_id]
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 2048)


def test_counts_of_odd_texts_and_special_strings(spark, odd, empty):
    tok = Tokenizer.from_file(tokenizer_file(WORDS))
    own = random_texts(300, seed=3) + ["a<|endoftext|>b <|startoftext|>", "\x1c x\x85y", "don't can'T", "ΑΣ ΑΣΑ", "é ́"]
    df = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    for r in token_counts.count_tokens(df, WORDS).collect():
        assert r.n_tokens == len(tok.encode(own[r.doc_id], add_special_tokens=False).ids), own[r.doc_id]
    rows = token_counts.count_tokens(odd, WORDS).collect()
    assert len(rows) == odd.count() and {r.n_tokens for r in rows if r.n_bytes == 0} == {0}
    cut = token_counts.count_tokens(odd, WORDS, slice_bytes=100).collect()
    assert sorted(rows, key=str) == sorted(cut, key=str)
    assert token_counts.count_tokens(empty, WORDS).count() == 0


def test_pieces_are_cut_only_after_white_space():
    raw = b"aaa bbb\tccccccccccccccc dd " * 50
    parts = list(token_counts.safe_pieces(raw, 20))
    assert b"".join(parts) == raw and all(p[-1:] in b" \t" for p in parts[:-1])
    assert list(token_counts.safe_pieces(b"x" * 100, 20)) == [b"x" * 100]


# ---------------------------------------------------------------- chat
@given(st.lists(st.sampled_from(list("<>|[]\\/sINTYim_ \n") + ["<|im_end|>", "[INST]", "</s>", "<<SYS>>", "é"]), max_size=40)
       .map("".join))
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_hides_controls(s):
    e = chat_format.escape_text(s)
    assert chat_format.unescape_text(e) == s
    assert not any(c in e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_spark_escape_equals_python_and_roles_survive(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_start|>user\n", "<\\|x", "a<b[c", "", "<<SYS>>"]
    df = spark.createDataFrame([(1, i, "a\n\\b<|", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    segments = [r.segment for r in chat_format.format_turns(df).orderBy("turn").collect()]
    assert [chat_format.parse_segment(s) for s in segments] == [("a\n\\b<|", t) for t in texts]


def test_op6_matches_its_sql(spark, sf_dir, con):
    df = QUERIES["op6_chat_format"](spark, sf_dir)
    r = con.execute(ORACLES["op6_chat_format"])
    names = [d[0] for d in r.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(r.fetchall())


def test_layouts_are_chosen_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 7},
        {"instruction": "q", "output": "a"}, {"instruction": "q", "input": "", "output": "a"},
        {"prompt": "q", "response": "a"}, {"question": "q", "answer": "a"}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(98, "[1]"), (99, None), (97, '{"x": 1}')],
                               "conv_id long, record string")
    got = {}
    for r in chat_format.turns_from_records(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert all(got[i] == [("user", "q"), ("assistant", "a")] for i in range(len(records)))
    assert got[97] == got[98] == got[99] == [(None, None)]


def test_table_layouts_use_the_same_fingerprints(spark):
    a = spark.sql("SELECT 1L AS conv_id, 'q' AS prompt, 'a' AS response")
    b = spark.sql("SELECT 1L AS conv_id, array(struct('human' AS `from`, 'q' AS value), struct('gpt' AS `from`, 'a' AS value)) AS conversations")
    for df in (a, b):
        assert [(r.role, r.text) for r in chat_format.turns_from_table(df).orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat_format.turns_from_table(spark.sql("SELECT 1L AS conv_id, 1 AS y"))


def test_chat_null_rows_ties_and_empty(spark):
    df = spark.createDataFrame([(1, 0, None, None), (1, 0, "assistant", "x"), (1, None, "user", "first"), (None, 1, "user", "n")],
                               "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    assert rows[1].n_turns == 3 and rows[1].loss_chars == 1 and rows[None].n_turns == 1
    assert rows[1].turns_sha256 == sha(b"user\nfirst\n\n\nassistant\nx\n")
    assert chat_format.read_back(chat_format.format_turns(df.where("false"))).count() == 0
