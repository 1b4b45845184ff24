"""A training corpus from raw documents: five stages, each one operator of ``kestrel.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run`
writes it as Parquet to shared storage and reads it back as the next stage's
documents.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import mixing, ngram_join, pii, sentencepiece_codec, toxicity
from kestrel.llm.queries import MIX_SEED, MIX_WEIGHTS
from kestrel.llm.tables import make_importable, read
from kestrel.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those the toxicity model rejects; the model learns from ``labels``."""
    make_importable(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(spark, docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    make_importable(spark)
    return ngram_join.keep_one_per_component(docs, n=5)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by kind names; ``n_chars`` follows the new text."""
    make_importable(spark)
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a global shuffle."""
    return mixing.repeat_documents(docs, MIX_WEIGHTS, seed=MIX_SEED)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, decoded text and source spans of every document, as digests."""
    make_importable(spark)
    return sentencepiece_codec.encode_decode_digests(docs, "piece_bpe_32k.model")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("pii", redact_pii),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

# A learned tagger and a tokenizer have no SQL form; the tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; the rows of the last one."""
    make_importable(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
