"""The pipeline, stage by stage, against plain Python on the rows each stage was given."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from test_join import brute
from test_scans import brute_pii

import corpus_pipeline
from kestrel.llm import mixing, toxicity
from kestrel.llm.tables import tokenizer_file


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """(name, input rows, output rows) of every stage, written and read as run() does."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, docs, sf_dir).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((name, docs, result))
        docs = result
    return {name: (a, b) for name, a, b in out}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "pii", "mix_sources", "sentencepiece"]
    for name, (a, b) in stages.items():
        assert name == "sentencepiece" or a.columns == b.columns


def test_toxic_documents_go_and_clean_ones_stay(spark, sf_dir, stages):
    a, b = stages["toxicity"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.score(a, toxicity.fit(spark, a, labels)).where("predicted = 1").collect()}
    assert {r.doc_id for r in b.collect()} == {r.doc_id for r in a.collect()} - rejected
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert not rejected & clean


def test_one_of_each_near_copy_group_stays(stages):
    a, b = stages["ngram_join"]
    _, component = brute({r.doc_id: r.text for r in a.collect()})
    assert sorted(r.doc_id for r in b.collect()) == sorted(set(component.values()))


def test_personal_data_is_replaced(stages):
    a, b = stages["pii"]
    after = {r.doc_id: r for r in b.collect()}
    assert len(after) == a.count()
    for r in a.collect():
        spans, text, at = sorted((s, -e, k) for k, s, e in brute_pii(r.text)), "", 0
        for s, e, k in spans:
            if s >= at:
                text += r.text[at:s] + f"<{k.upper()}>"
                at = -e
            else:
                at = max(at, -e)
        assert after[r.doc_id].text == text + r.text[at:] and after[r.doc_id].n_chars == len(after[r.doc_id].text)


def test_mixing_repeats_whole_rows(stages):
    a, b = stages["mix_sources"]
    want = sorted(tuple(r)[:5] for r in mixing.mix(a, corpus_pipeline.MIX_WEIGHTS, seed=corpus_pipeline.MIX_SEED).collect())
    assert sorted(map(tuple, b.collect())) == want


def test_last_stage_and_run_agree(spark, sf_dir, stages):
    a, b = stages["sentencepiece"]
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in b.collect())
    want = []
    for r in a.collect():
        ids = lib.encode(r.text, add_bos=True, add_eos=True)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert got == sorted(want)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in whole.collect()) == got


def test_stages_take_odd_and_empty_documents(spark, sf_dir, odd):
    for df in (odd, odd.where("false")):
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, df, sf_dir)
            if name != "sentencepiece":
                assert out.columns == df.columns
            out.count()
