"""Extra columns whose names clash with results or helpers, on every operator and stage."""

import pytest
from pyspark.sql import functions as F

from kestrel.llm import (alignment, ball_tree, chat_format, divergence, mixing, ngram_join, pii, quality_rules, secret_scan,
                         sentencepiece_codec, token_counts)

HELPERS = ["__source", "__steps", "__draws", "__rate", "__copies", "__salt", "__key", "__gone", "__id", "rep", "digest", "key",
           "grams", "u", "v", "id", "h", "tokens", "context", "lang_n", "block", "links", "n_a", "bucket", "score_", "a.b", "x y"]
OUTPUTS = ["Rate", "Copies", "COPY_NO", "Shuffle_Key", "N_Tokens", "Spans", "component_id", "Kept", "Failures"]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame(
        [(k, f"mail bob{k}@example.org or call +44 20 7946 0{100 + k} for the words of text number {k % 4} " * 3, "en", f"s{k % 3}")
         for k in range(12)] + [(None, None, None, None)], "doc_id long, text string, lang string, source string")
    return docs, docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in HELPERS + OUTPUTS])


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("operator", [
    lambda d: sentencepiece_codec.encode_decode_digests(d, "piece_bpe_32k.model"), pii.find_pii,
    lambda d: token_counts.count_tokens(d, "word_bpe_49k.json"), secret_scan.scan_secrets, quality_rules.ledger,
    lambda d: divergence.audit_sources(d, least_docs=2),
    lambda d: alignment.align_tokenizers(d, "byte_bpe_50k.json", "piece_bpe_32k.model")],
    ids=["pieces", "pii", "counts", "secrets", "quality", "audit", "alignment"])
def test_results_do_not_depend_on_extra_columns(rows, operator):
    same(operator(rows[0]), operator(rows[1]))


def test_mixing_with_clashing_columns(rows):
    plain, more = (mixing.mix(d, {"s1": 3.0}, seed=4) for d in rows)
    assert more.columns == ["doc_id", "text", "lang", "source", *HELPERS, *OUTPUTS[4:], *mixing.OUTPUT]
    same(plain, more.select(*plain.columns))
    held = more.select("Spans", "`a.b`", "__source").distinct().collect()
    assert [tuple(r) for r in held] == [("extra Spans", "extra a.b", "extra __source")]


@pytest.mark.parametrize("stage", [lambda d: mixing.repeat_documents(d, {"s1": 3.0}, seed=4), ngram_join.keep_one_per_component,
                                   pii.redact], ids=["mix", "join", "pii"])
def test_stages_return_the_input_columns(rows, stage):
    plain, more = map(stage, rows)
    assert more.columns == rows[1].columns
    assert sorted(map(str, more.select(*rows[0].columns).collect())) == sorted(map(str, plain.collect()))
    for c in HELPERS + OUTPUTS:
        assert {r[0] for r in more.select(f"`{c}`").collect()} == {f"extra {c}"}


def test_vectors_with_clashing_columns(spark):
    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(9)], "vec_id long, embedding array<float>")
    more = df.select("*", *[F.lit("x").alias(c) for c in ("vector", "pivot", "shard", "Rank", "Score", "query_id", "bar")])
    same(ball_tree.exact_top_k(df, 4, 3), ball_tree.exact_top_k(more, 4, 3))


def test_conversations_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None)], "conv_id long, turn long, role string, text string")
    more = df.select("*", *[F.lit("x").alias(c) for c in ("N_Turns", "formatted", "segment", "mask", "__turn")])
    read = [chat_format.read_back(chat_format.format_turns(chat_format.turns_from_table(d, columns=chat_format.CANONICAL))) for d in (df, more)]
    same(*read)
