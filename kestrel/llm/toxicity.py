"""Toxic spans by a linear-chain CRF, and document scores from its marginals.

Labels mark documents, the field tags tokens.  Token labels come from corpus
counts over labelled documents: a word or word prefix is evidence when toxic
documents hold it far more often than clean ones, next to many different words
(a copied passage always shows the same neighbours).  Tokens of toxic documents
with such evidence are the labelled toxic tokens; the field then learns how much
each feature and each neighbour counts, and forward-backward marginals of a
whole text give its score and the offending offsets.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import SLICE_BYTES, byte_slices
from kestrel.llm.crf import ChainCRF
from kestrel.llm.token_cache import WordMemo

MAX_LABELLED = 12_000           # labelled documents the model is fitted on (the smallest hashes of their ids)
MAX_FEATURES = 20_000           # evidence features kept, by strength
MAX_CHAINS = 6_000              # token windows the field is trained on
CHAIN = 31                      # tokens of a window
PREFIXES = (4, 5, 6)
MIN_TOXIC, MIN_SHARE, MIN_NEIGHBOURS = 4, 0.8, 4
HOLD_OUT = 5                    # rows with crc32(doc_id) mod 5 = 0 are never learned from

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def token_features(word: str) -> list[str]:
    """The bare lower-case word and its prefixes; none for a token without letters."""
    bare = _EDGES.sub("", word).lower()
    return [f"w:{bare}"] + [f"{k}:{bare[:k]}" for k in PREFIXES if len(bare) > k] if bare else []


def held_out(doc_id) -> "F.Column":
    """Whether a document is kept from learning; false for a row without an id."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % HOLD_OUT == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """``text, toxic`` of at most ``limit`` labelled documents outside the held-out part.

    The sample is the smallest hashes of the labelled ids, so it is the same at
    every run; with at most ``limit`` ids its broadcast is bounded.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
           .orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(limit))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.where("text IS NOT NULL").join(F.broadcast(ids), "doc_id").select("text", "toxic")


def _evidence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature: toxic and clean documents of the stretch, and hashes of a few words before it in toxic ones."""
    toxic, clean, beside = {}, {}, {}
    for part in byte_slices(batches, "text"):
        for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
            words = _WORD.findall(text or "")
            seen: dict[str, int] = {}
            for k, w in enumerate(words):
                if w not in seen:
                    seen[w] = zlib.crc32(words[k - 1].encode()) if k else 0
            feats = {}
            for w, near in seen.items():
                for f in token_features(w):
                    feats[f] = near
            count = toxic if label else clean
            for f, near in feats.items():
                count[f] = count.get(f, 0) + 1
                if label:
                    s = beside.setdefault(f, set())
                    if len(s) < 8:
                        s.add(near)
    names = [*toxic, *(f for f in clean if f not in toxic)]
    for a in range(0, len(names), 50_000):
        own = names[a:a + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array([toxic.get(f, 0) for f in own], pa.int64()),
             pa.array([clean.get(f, 0) for f in own], pa.int64()),
             pa.array([sorted(beside.get(f, ())) for f in own], pa.list_(pa.int64()))],
            ["feature", "toxic", "clean", "beside"])


def evidence(sample: DataFrame, limit: int = MAX_FEATURES) -> list[str]:
    """The features that tell toxic documents from clean ones, strongest first."""
    counted = sample.mapInArrow(_evidence_batches, "feature string, toxic long, clean long, beside array<long>")
    strong = (counted.groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
        F.size(F.array_distinct(F.flatten(F.collect_list("beside")))).alias("neighbours"))
        .where((F.col("toxic") >= MIN_TOXIC) & (F.col("neighbours") >= MIN_NEIGHBOURS)
               & (F.col("toxic") >= MIN_SHARE * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.col("toxic").desc(), "feature").limit(limit))
    return [r["feature"] for r in strong.select("feature").collect()]


def _chain_batches(batches: Iterator[pa.RecordBatch], features: frozenset, per_clean: int) -> Iterator[pa.RecordBatch]:
    """Windows of tokens with tags: around evidence in toxic documents, spread evenly over clean ones."""
    for part in byte_slices(batches, "text"):
        tokens, tags, order = [], [], []
        for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
            words = _WORD.findall(text or "")
            if len(words) < 2:
                continue
            marks = [any(f in features for f in token_features(w)) for w in words]
            if label:
                centres = [k for k, m in enumerate(marks) if m][::3][:4]
            else:
                centres = [k for k, m in enumerate(marks) if m][:2] + [len(words) * (2 * i + 1) // (2 * per_clean)
                                                                      for i in range(per_clean)]
            for c in centres:
                a = max(0, min(c - CHAIN // 2, len(words) - CHAIN))
                tokens.append(words[a:a + CHAIN])
                tags.append([int(label and m) for m in marks[a:a + CHAIN]])
                order.append(int(np.random.default_rng(len(text) * 31 + c).integers(1 << 62)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int32())), pa.array(order, pa.int64())],
            ["tokens", "tags", "shuffle"])


@dataclass
class ToxicityModel:
    """A fitted field: feature weights, chain weights and the calibration of the document score."""

    features: dict[str, int]
    crf: ChainCRF
    slope: float = 1.0
    offset: float = 0.0

    def score_words(self, words: list[str]) -> list[float]:
        """Summed feature weights per word; 0 exactly where no feature fires."""
        known, w = self.features, self.crf.weights
        out = []
        for word in words:
            hits = [known[f] for f in token_features(word) if f in known]
            out.append(float(w[hits].sum()) if hits else 0.0)
        return out

    def tag(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions with evidence, their toxic marginals)."""
        at = np.flatnonzero(scores)
        return at, self.crf.posterior(at, scores[at], len(scores))

    def evidence_of(self, marginals: np.ndarray) -> float:
        """Log-odds that a token of the text is toxic (noisy-or over the marginals), within +-12."""
        none = float(np.log1p(-np.minimum(marginals, 1 - 1e-9)).sum()) if len(marginals) else -1e-9
        return float(np.clip(np.log(max(-np.expm1(none), 1e-9)) - none, -12, 12))

    def document_score(self, marginals: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.evidence_of(marginals) + self.offset))))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit by Newton steps with a weak prior."""
    theta = np.array([0.5, 0.0])
    a = np.stack((x, np.ones_like(x)), 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ theta))
        g = a.T @ (y - p) - 0.1 * (theta - np.array([0.5, 0.0]))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2)
        step = np.linalg.solve(h, g)
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.05)), float(theta[1])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Fit the field on a bounded sample of labelled documents (``max_labelled``).

    Reads ``doc_id, text`` of documents and ``doc_id, toxic`` of labels, nothing
    else.  Without labels of both kinds, or without evidence, the model finds
    every text clean.
    """
    sample = labelled_sample(docs, labels, max_labelled).persist()
    try:
        features = evidence(sample)
        model = ToxicityModel({f: i for i, f in enumerate(features)}, ChainCRF(len(features)), 1.0, 0.0)
        if not features:
            return model
        known = spark.sparkContext.broadcast(frozenset(features))
        rows = (sample.mapInArrow(lambda b: _chain_batches(b, known.value, 1),
                                  "tokens array<string>, tags array<int>, shuffle long")
                .orderBy("shuffle", F.col("tokens").cast("string")).limit(MAX_CHAINS).collect())
        slots = 1 + len(PREFIXES)
        index = np.full((len(rows), CHAIN, slots), -1, dtype=np.int64)
        tags = np.zeros((len(rows), CHAIN))
        for i, r in enumerate(rows):
            tags[i, :len(r["tags"])] = r["tags"]
            for t, w in enumerate(r["tokens"]):
                hits = [model.features[f] for f in token_features(w) if f in model.features]
                index[i, t, :len(hits)] = hits
        model.crf.fit(index, tags)
        fitted = spark.sparkContext.broadcast(model)
        points = np.array(sample.mapInArrow(lambda b: _point_batches(b, fitted.value), "x double, y double")
                          .toPandas().to_numpy(), dtype=float)
        if len(np.unique(points[:, 1])) == 2:
            model.slope, model.offset = _calibrate(points[:, 0], points[:, 1])
        return model
    finally:
        sample.unpersist()


def _scored(batches: Iterator[pa.RecordBatch], model: ToxicityModel, slice_bytes: int):
    """(slice, per text: its words' scores)."""
    memo = WordMemo(model.score_words, 200_000)
    for part in byte_slices(batches, "text", slice_bytes):
        split = [_WORD.findall(t or "") for t in part.column("text").to_pylist()]
        known = memo.lookup(set().union(*split))
        yield part, [np.fromiter(map(known.__getitem__, w), dtype=float, count=len(w)) for w in split]


def _point_batches(batches, model):
    for part, scored in _scored(batches, model, SLICE_BYTES):
        x = [model.evidence_of(model.tag(s)[1]) for s in scored]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), part.column("toxic").cast(pa.float64())], ["x", "y"])


def _tag_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    for part, scored in _scored(batches, model, slice_bytes):
        score, spans, count = [], [], []
        for k, s in enumerate(scored):
            at, p = model.tag(s)
            score.append(model.document_score(p))
            bad = at[p >= 0.5]
            count.append(len(bad))
            if len(bad):
                wanted, text = set(bad.tolist()), part.column("text")[k].as_py()
                spans.append(",".join(f"{m.start()}:{m.end()}" for i, m in enumerate(_WORD.finditer(text)) if i in wanted))
            else:
                spans.append("")
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), pa.array(score, pa.float64()), pa.array(count, pa.int64()), pa.array(spans, pa.string())],
            ["row", "score", "n_toxic_tokens", "toxic_spans"])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
          slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, score, predicted, n_toxic_tokens, toxic_spans``.

    ``toxic_spans`` lists ``start:end`` (code points, end exclusive) of tokens
    whose marginal is 0.5 or more.  Only the text is scored.  Null or empty text
    gets the score of no evidence; ids may be null or repeat (one row per input
    row); other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("row"), F.col(text_col).cast("string").alias("text"))
    tagged = rows.mapInArrow(lambda b: _tag_batches(b, shared.value, slice_bytes),
                             "row long, score double, n_toxic_tokens long, toxic_spans string")
    return tagged.select(F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic_tokens", "toxic_spans")


def _keep_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel, text: str) -> Iterator[pa.RecordBatch]:
    memo = WordMemo(model.score_words, 200_000)
    for part in byte_slices(batches, text):
        split = [_WORD.findall(t or "") for t in part.column(text).to_pylist()]
        known = memo.lookup(set().union(*split))
        keep = [model.document_score(model.tag(np.fromiter(map(known.__getitem__, w), dtype=float, count=len(w)))[1]) < 0.5
                for w in split]
        yield part.filter(pa.array(keep, pa.bool_()))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The input rows, all columns as they are, without those whose text is predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda b: _keep_batches(b, shared.value, text_col), docs.schema)
