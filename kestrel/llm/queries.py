"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import alignment, ann, ball_tree, chat_format, divergence, mixing, ngram_join, pii, quality_rules, secret_scan, sentencepiece_codec, token_counts, toxicity
from kestrel.llm.tables import make_importable, read
from kestrel.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            make_importable(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


# Production mix: the largest source at the weight of two, the others alike.
MIX_WEIGHTS = {"src0": 2.0}
MIX_SEED = 11

_OP1_SQL = """
WITH RECURSIVE size AS (
  SELECT source, count(*) AS n, sum(coalesce(length(text), 0)) AS chars FROM documents GROUP BY source),
w AS (SELECT source, chars, CASE WHEN chars = 0 THEN 0.0::DOUBLE WHEN source = 'src0' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM size),
tot AS (SELECT sum(weight) AS tw, sum(chars) AS tc FROM w WHERE weight > 0),
rates AS (SELECT source, CASE WHEN weight > 0 THEN weight / tw * (1.0::DOUBLE * tc) / chars ELSE 0.0::DOUBLE END AS rate FROM w, tot),
parts AS (SELECT source, rate, greatest(1, ceil(rate / 8.0))::BIGINT AS draws FROM rates),
steps AS (
  SELECT source, draws, rate / draws AS r, 0 AS k, exp(-(rate / draws)) AS p, exp(-(rate / draws)) AS c FROM parts
  UNION ALL SELECT source, draws, r, k + 1, p * r / (k + 1), c + p * r / (k + 1) FROM steps WHERE k < 40),
u AS (
  SELECT d.doc_id, d.source, p.rate, i,
         ((('0x' || substr(md5('count:11:' || i || ':' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT)::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, generate_series(1, p.draws) g(i)),
n AS (
  SELECT doc_id, any_value(u.source) AS source, any_value(rate) AS rate, count(s.k) AS copies
  FROM u LEFT JOIN steps s ON s.source IS NOT DISTINCT FROM u.source AND s.c <= u.u GROUP BY doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, j::INT AS copy_no, copies::INT AS copies, rate,
       ('0x' || substr(md5('order:11:' || j || ':' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS shuffle_key
FROM documents d JOIN n USING (doc_id), generate_series(1, copies) g(j)
"""


@_query("op1_mix_sources", _OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, globally shuffled."""
    return mixing.mix(read(spark, sf_dir, "documents"), MIX_WEIGHTS, seed=MIX_SEED)


@_query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids, decoded text and source spans."""
    docs = read(spark, sf_dir, "documents")
    return sentencepiece_codec.encode_decode_digests(docs, "piece_bpe_32k.model")


@_query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.find_pii(read(spark, sf_dir, "documents"))


@_query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, tokens and the over-limit flag of every document."""
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), "word_bpe_49k.json", limit=2048)


@_query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secret_scan.scan_secrets(read(spark, sf_dir, "documents"))


_OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, len(regexp_extract_all(text, '(<|\[)\\*(\||/?s>|/?INST\]|</?SYS>>)')) AS escapes FROM t)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(text) + escapes + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query("op6_chat_format", _OP6_SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation, and conversation -1 of control strings; digests read back from the output."""
    control = "</s>[INST] ok [/INST]"
    record = json.dumps({"messages": [{"role": r, "content": control} for r in ("user", "assistant")]})
    extra = chat_format.turns_from_records(
        spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(record).alias("record")))
    table = chat_format.turns_from_table(read(spark, sf_dir, "conversations"), columns=chat_format.CANONICAL)
    return chat_format.read_back(chat_format.format_turns(table.unionByName(extra.select(*chat_format.CANONICAL))))


@_query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score, verdict and offending offsets of every document, learned from labelled ones."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(spark, docs, read(spark, sf_dir, "labels")))


@_query("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return ann.nearest(read(spark, sf_dir, "embeddings"), query_every=20, k=20)


_WORD = r"[^\x20\x09-\x0D]+"

_OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(regexp_extract_all(text, '{_WORD}')) AS word,
             generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) AS pos FROM d),
g AS (SELECT rid, pos, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3
      FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
r AS (SELECT rid, pos, (count(*) OVER (PARTITION BY rid, word, w2, w3)) > 1 AND w3 IS NOT NULL AS twice FROM g),
c AS (SELECT rid, pos, twice OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS hit
      FROM r WINDOW o AS (PARTITION BY rid ORDER BY pos)),
n AS (SELECT rid, count(*) AS n_words, sum(hit::INT) AS n_repeat_words FROM c GROUP BY rid),
ch AS (SELECT rid, sum(length(word)) AS word_chars FROM w GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0)::BIGINT AS n_lines
      FROM d LEFT JOIN n USING (rid) LEFT JOIN ch USING (rid) LEFT JOIN lw USING (rid)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 8 ELSE 0 END
             + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END
             + CASE WHEN n_words > 100000 THEN 32 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, failures,
       (failures & 3) <> 0 AS base_failed, (failures & 31) = 0 AS kept FROM f
"""


@_query("op9_quality_rules", _OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of every document with the verdicts of the base and default policies."""
    rows = quality_rules.ledger(read(spark, sf_dir, "documents"))
    rows = quality_rules.apply_policy(rows, "base-v1", "base_ok")
    rows = quality_rules.apply_policy(rows, "default-v1", "kept")
    return rows.select("doc_id", *quality_rules.MEASURES, "failures", (~F.col("base_ok")).alias("base_failed"), "kept")


_ABLATION_RULES = ", ".join(
    f"('{policy}', {quality_rules.policy_mask(policy)}, '{r.name}', {1 << r.bit})"
    for policy, names in quality_rules.POLICIES.items() for r in quality_rules.RULES if r.name in names)

_ABLATION_SQL = _OP9_SQL[:_OP9_SQL.rindex("SELECT doc_id")] + f""", p(policy, mask, rule, bit) AS (VALUES {_ABLATION_RULES})
SELECT policy, rule, count(*) FILTER (failures & bit <> 0) AS rejected, count(*) FILTER (failures & mask = bit) AS rejected_alone,
       count(*) FILTER (failures & mask & ~bit = 0) AS kept_without FROM f, p GROUP BY policy, rule
"""


@_query("quality_ablation", _ABLATION_SQL)
def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule does in each policy: documents it rejects, rejects alone, and documents kept without it."""
    path = scratch_path(spark, "quality-ledger")
    quality_rules.ledger(read(spark, sf_dir, "documents")).select("failures").write.parquet(path)
    rows, out = spark.read.parquet(path), None
    for policy in quality_rules.POLICIES:
        own = quality_rules.ablation(rows, policy).select(F.lit(policy).alias("policy"), "rule", "rejected", "rejected_alone", "kept_without")
        out = own if out is None else out.unionAll(own)
    return out


@_query("op10_ngram_join")
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of every document."""
    return ngram_join.ngram_components(read(spark, sf_dir, "documents"), n=5)


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

_OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '{_TERM}')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
size AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY ALL),
g AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, lang_total
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN total USING (lang, source) LEFT JOIN size USING (lang)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v)::HUGEINT AS q
      FROM g JOIN kept USING (lang) LEFT JOIN held USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@_query("op11_source_audit", _OP11_SQL)
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from its language's other sources, and the terms it overuses."""
    return divergence.audit_sources(read(spark, sf_dir, "documents"), least_docs=30, top_terms=50)


@_query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of two tokenizers in every document, with corpus-wide counts of the linked id pairs."""
    return alignment.align_tokenizers(read(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")


_OP13_SQL = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@_query("op13_exact_topk", _OP13_SQL)
def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 rows of largest whole-number inner product of every hundredth vector."""
    return ball_tree.exact_top_k(read(spark, sf_dir, "embeddings"), query_every=100, k=10, scale=1024)
