"""Secrets in whole texts: fixed shapes, plus random strings exposed by token efficiency.

A byte-pair vocabulary learned on prose needs many tokens for a random string.
Characters per token below a threshold therefore expose keys that no pattern
names; known digests and identifiers are random too and are excluded first.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import SLICE_BYTES, byte_slices
from kestrel.llm.tables import tokenizer_file

# Fixed patterns of the base kinds, in the order that breaks ties.
ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("random",)
_ASSIGN_HINT = re.compile(r"(?ai:password|passwd|secret|token|api_?key)")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Random by construction, yet public: digests by their length, UUIDs, decimal numbers and compact times.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_TIME = re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9]{2}-?[0-9]{2}-?[0-9]{2}Z?")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_SEPARATORS = re.compile(r"[+/_=-]+")
_NAME_PART = re.compile(r"[A-Za-z]+[0-9]{0,4}|[0-9]{1,8}")
_CASE_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
NAME_RATIO = 2.5                # characters per token that the lower-cased words of a name reach


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed shapes by start, then kind; failing matches are dropped, not retried."""
    out = []
    if (":" in text or "=" in text) and _ASSIGN_HINT.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def is_known_public(s: str) -> bool:
    """Digests, UUIDs, times, numbers and rules: not secret by themselves, however many tokens they need."""
    bare = s.strip("_=-/+")
    digits = _SEPARATORS.sub("", bare)
    if not digits or digits.isdigit() or _UUID.fullmatch(bare) or _TIME.fullmatch(bare):
        return True
    return len(bare) in DIGEST_LENGTHS and _HEX_ONLY.fullmatch(bare) is not None


def is_identifier(s: str, efficiency: TokenEfficiency, min_ratio: float = NAME_RATIO) -> bool:
    """Names and paths: the words between separators and case changes are words to the vocabulary, whatever their case.

    Digits stand only behind a word or alone.  A string of one word is judged as it is by its own ratio.
    """
    if not all(_NAME_PART.fullmatch(p) for p in _SEPARATORS.split(s) if p):
        return False
    words = [w.lower() for w in _CASE_WORD.findall(s)]
    return sum(map(len, words)) >= min_ratio * sum(map(efficiency.tokens, words))


class TokenEfficiency:
    """Characters per token under a tiktoken vocabulary."""

    def __init__(self, ranks_file: str):
        import public_tokenizers
        import tiktoken

        ranks = {}
        with open(ranks_file, "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self._encoding = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN,
                                           mergeable_ranks=ranks, special_tokens={})

    def tokens(self, s: str) -> int:
        return len(self._encoding.encode_ordinary(s))

    def __call__(self, s: str) -> float:
        return len(s) / self.tokens(s)


@functools.lru_cache(maxsize=2)
def _efficiency(name: str) -> TokenEfficiency:
    return TokenEfficiency(name if os.path.isabs(name) else tokenizer_file(name))


def random_spans(text: str, efficiency: TokenEfficiency, max_ratio: float,
                 taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidate strings outside the base spans whose characters per token stay under ``max_ratio``."""
    out = []
    for m in _CANDIDATE.finditer(text):
        s = m[0]
        if is_known_public(s) or any(a < m.end() and m.start() < b for _, a, b in taken):
            continue
        if efficiency(s) < max_ratio and not is_identifier(s, efficiency, max(NAME_RATIO, max_ratio)):
            out.append(("random", m.start(), m.end()))
    return out


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch], vocabulary: str, max_ratio: float,
                  slice_bytes: int) -> Iterator[pa.RecordBatch]:
    efficiency = _efficiency(vocabulary)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    for part in byte_slices(batches, "text", slice_bytes):
        cols: dict[str, list] = {n: [] for n in names[1:]}
        for text in part.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            more = random_spans(text, efficiency, max_ratio, base)
            per_kind = Counter(s[0] for s in base)
            every = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))
            for k in BASE_KINDS:
                cols[f"n_{k}"].append(per_kind[k])
            cols["base_sha256"].append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            cols["spans"].append(join_spans(every))
            cols["n_random"].append(len(more))
        kinds = {"base_sha256": pa.string(), "spans": pa.string()}
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id")] + [pa.array(cols[n], kinds.get(n, pa.int64())) for n in names[1:]], names)


def scan_secrets(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", max_ratio: float = 1.9,
                 id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Secret spans (code points, end exclusive) of every whole text, one row per input row.

    Base kinds ``assign``, ``access`` and ``hex`` are leftmost non-overlapping
    matches of their patterns.  Kind ``random`` adds strings of 16 or more
    characters that overlap no base span, give fewer than ``max_ratio`` characters
    per token of ``vocabulary``, and are neither a known digest, number or time
    nor a name whose words the vocabulary holds.

    Columns: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random``
    (spans joined as ``kind:start:end`` by start, then kind).  Null or empty text
    has no spans (the digest is that of the empty string); ids may be null or
    repeat; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        lambda b: _scan_batches(b, vocabulary, max_ratio, slice_bytes),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
