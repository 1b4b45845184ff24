"""Alignment of two tokenizers' tokens on the same text, and corpus-wide counts of aligned id pairs.

The cumulative byte ends of each token list go into an end-to-index dictionary;
the ends that both dictionaries hold cut the two lists into groups, and the
tokens of a group's two slices that end together are linked.  Texts are cut
where no token of either side can run across, so a stretch is encoded and
aligned once per memo and a text's result is the concatenation of its
stretches'.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import SLICE_BYTES, byte_slices, text_buffers
from kestrel.llm.tables import tokenizer_file
from kestrel.session import scratch_path

MARK = "▁"                       # the visible blank of pieces
MEMO_BYTES = 128 << 20           # text and results of stretches a Python worker remembers
ENTRY_BYTES = 400                # what one remembered stretch costs besides
HELD_PAIRS = 1 << 20             # distinct id pairs a counting task holds before it hands them on

# One blank behind a visible character and before a letter, digit or underscore.  No byte-level
# pre-token and no piece goes on across the place in front of such a blank.
_CUT = re.compile(r"(?<=\S) (?=\w)")


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on in order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def common_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The byte ends that both token lists have, in order, and how many tokens of each list lie up to them."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))         # of tokens without bytes the last one counts
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    ends = sorted(index_a.keys() & index_b.keys())
    return ends, [index_a[e] for e in ends], [index_b[e] for e in ends]


def align(ids_a: list[int], sizes_a: list[int], ids_b: list[int], sizes_b: list[int]):
    """(groups, links) of two token lists over the same bytes.

    A group is a pair of slices ``(ids of a, ids of b)`` between two neighbouring
    common ends; a link is a pair ``(id of a, id of b)`` of tokens that end at the
    same byte.
    """
    ends_a, ends_b = list(accumulate(sizes_a)), list(accumulate(sizes_b))
    groups, links, from_a, from_b = [], [], 0, 0
    for end, to_a, to_b in zip(*common_ends(ends_a, ends_b)):
        groups.append((ids_a[from_a:to_a], ids_b[from_b:to_b]))
        links.extend((ids_a[i], ids_b[j]) for i in range(from_a, to_a) if ends_a[i] == end
                     for j in range(from_b, to_b) if ends_b[j] == end)
        from_a, from_b = to_a, to_b
    return groups, links


def written(groups) -> str:
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


class Aligner:
    """A byte-level tokenizer file (A) and a SentencePiece model (B) that puts a blank before the text."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # one core per task is Spark's to give
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model = schema.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        kinds = schema.ModelProto.SentencePiece
        self.bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace(MARK, " ").encode()
                        for p in model.pieces]
        self.sizes_a, self.sizes_b = (np.array([len(p) for p in v], dtype=np.int64) for v in (self.bytes_a, self.bytes_b))
        # ids as written inside and at the end of a group's tokens of a (4 i, 4 i + 1) and of b (4 i + 2, 4 i + 3)
        self._shown = [f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for end in ",|,;"]
        self.code = np.dtype("<u4" if len(self.bytes_a) * len(self.bytes_b) < 1 << 32 else "<u8")
        spec, config = model.normalizer_spec, json.loads(self.a.to_str())
        before = config["pre_tokenizer"] or {}
        self.by_stretch = (
            not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == kinds.USER_DEFINED or MARK in p.piece.lstrip(MARK) for p in model.pieces)
            and config["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex")
            and not before.get("add_prefix_space"))
        self._held, self._held_bytes = {}, 0

    def stretches(self, text: str) -> list[str]:
        """Parts of the text, each encoded apart behind a blank of its own; together they give the whole text's tokens."""
        return _CUT.split(text) if self.by_stretch else [text]

    def _align(self, stretches: list[str]) -> Iterator[tuple]:
        """Per stretch: (tokens of a, tokens of b, groups, written groups, packed links), or None where bytes differ."""
        spaced = [" " + s for s in stretches]
        ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode(stretches, num_threads=1)
        raw = [s.encode() for s in spaced]
        same = [b"".join(map(self.bytes_a.__getitem__, a)) == r == b"".join(map(self.bytes_b.__getitem__, b))
                for a, b, r in zip(ids_a, ids_b, raw)]
        found = iter(self._align_all([a for a, ok in zip(ids_a, same) if ok], [b for b, ok in zip(ids_b, same) if ok],
                                     [len(r) for r, ok in zip(raw, same) if ok]))
        return (next(found) if ok else None for ok in same)

    def _align_all(self, lists_a: list[list[int]], lists_b: list[list[int]], lengths: list[int]) -> list[tuple]:
        """The same for stretches of equal bytes, aligned as one text: the end of a stretch is common to both."""
        if not lengths:
            return []
        a, b = np.fromiter(chain.from_iterable(lists_a), np.int64), np.fromiter(chain.from_iterable(lists_b), np.int64)
        size_a, size_b = self.sizes_a[a], self.sizes_b[b]
        if not (size_a.all() and size_b.all()):                    # tokens without bytes: one stretch at a time
            out = []
            for x, y in zip(lists_a, lists_b):
                groups, links = align(x, self.sizes_a[x].tolist(), y, self.sizes_b[y].tolist())
                packed = np.array([i * len(self.bytes_b) + j for i, j in links], dtype=self.code).tobytes()
                out.append((len(x), len(y), len(groups), written(groups), packed))
            return out
        ends, to_a, to_b = (np.array(x) for x in common_ends(np.cumsum(size_a).tolist(), np.cumsum(size_b).tolist()))
        # the tokens of both in the order they are written: group by group, those of a before those of b
        group_a = np.searchsorted(to_a, np.arange(len(a)), side="right")
        group_b = np.searchsorted(to_b, np.arange(len(b)), side="right")
        place_a, place_b = np.arange(len(a)), np.arange(len(b)) + to_a[group_b]
        place_a += np.concatenate(([0], to_b))[group_a]
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[to_a - 1] = last_b[to_b - 1] = 1
        shown = np.empty(len(a) + len(b), dtype=np.int64)
        shown[place_a] = a * 4 + last_a
        shown[place_b] = b * 4 + 2 + last_b
        shown = list(map(self._shown.__getitem__, shown.tolist()))
        links = (a[to_a - 1] * len(self.bytes_b) + b[to_b - 1]).astype(self.code).tobytes()
        groups = np.searchsorted(ends, np.cumsum(lengths), side="right")
        counts = np.diff(groups, prepend=0).tolist()
        done_a, done_b = to_a[groups - 1], to_b[groups - 1]
        width, out, from_shown, from_link = self.code.itemsize, [], 0, 0
        for n_a, n_b, n, to_shown, to_link in zip(np.diff(done_a, prepend=0).tolist(), np.diff(done_b, prepend=0).tolist(), counts,
                                                  (done_a + done_b).tolist(), (groups * width).tolist()):
            out.append((n_a, n_b, n, "".join(shown[from_shown:to_shown])[:-1], links[from_link:to_link]))
            from_shown, from_link = to_shown, to_link
        return out

    def lookup(self, wanted: set[str]) -> dict:
        """Results of the stretches; beyond ``MEMO_BYTES`` only those asked for now are kept."""
        missing = [s for s in wanted if s not in self._held]
        if missing:
            found = dict(zip(missing, self._align(missing)))
            size = sum(ENTRY_BYTES + 2 * len(s) + (len(r[3]) + len(r[4]) if r else 0) for s, r in found.items())
            if self._held_bytes + size > MEMO_BYTES:
                self._held, self._held_bytes = {s: self._held[s] for s in wanted if s in self._held}, 0
            self._held.update(found)
            self._held_bytes += size
        return self._held

    def documents(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, written groups, packed links) of every text; zeros where it has no tokens."""
        split = [self.stretches(t) if t else [] for t in texts]
        known = self.lookup(set().union(*split))
        for parts in split:
            found = [known[s] for s in parts]
            if not found or None in found:
                yield 0, 0, 0, "", b""
            else:
                a, b, groups, shown, packed = zip(*found)
                yield sum(a), sum(b), sum(groups), ";".join(shown), b"".join(packed)


def possible_pairs(bytes_a: list[bytes], bytes_b: list[bytes]) -> int:
    """How many id pairs can ever be linked, whatever the corpus.

    Two linked tokens end at the same byte of the same text, so the bytes of one
    are a suffix of the other's.
    """
    def ids(vocabulary):
        out = {}
        for piece in vocabulary:
            if piece:
                out[piece] = out.get(piece, 0) + 1
        return out
    of_a, of_b = ids(bytes_a), ids(bytes_b)
    longer_a = sum(n * of_b.get(p[k:], 0) for p, n in of_a.items() for k in range(len(p)))
    longer_b = sum(n * of_a.get(p[k:], 0) for p, n in of_b.items() for k in range(1, len(p)))
    return longer_a + longer_b


@functools.lru_cache(maxsize=2)
def aligner(name_a: str, name_b: str) -> Aligner:
    """The aligner of two files (installed public names or absolute paths), kept by the Python worker."""
    return Aligner(*(n if os.path.isabs(n) else tokenizer_file(n) for n in (name_a, name_b)))


def _align_batches(batches: Iterator[pa.RecordBatch], names: tuple[str, str], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    al = aligner(*names)
    for part in byte_slices(batches, "text", slice_bytes):
        offsets, raw = text_buffers(part.column("text"))
        texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        rows = [(a, b, g, len(packed) // al.code.itemsize, hashlib.sha256(w.encode()).hexdigest() if a else "", packed)
                for a, b, g, w, packed in al.documents(texts)]
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
             pa.array(cols[5], pa.binary())],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])


def _pair_batches(batches: Iterator[pa.RecordBatch], code: str) -> Iterator[pa.RecordBatch]:
    """Distinct id pairs of the task's links with counts."""
    held, size = [], 0

    def merged():
        pairs = np.concatenate([h[0] for h in held])
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], np.concatenate([h[1] for h in held])[order]
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        return pairs[first], np.add.reduceat(counts, first)

    def rows(pairs, counts):
        return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(counts.astype(np.int64))], ["pair", "n"])

    for part in batches:
        blob = b"".join(part.column("links").to_pylist())
        if blob:
            held.append(np.unique(np.frombuffer(blob, dtype=code), return_counts=True))
            size += len(held[-1][0])
        if size > HELD_PAIRS:
            held = [merged()]
            size = len(held[0][0])
            if size > HELD_PAIRS // 2:
                yield rows(*held[0])
                held, size = [], 0
    if held:
        yield rows(*merged())


def _count_batches(batches: Iterator[pa.RecordBatch], code: str, pairs: np.ndarray, counts: np.ndarray,
                   best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The documents with the counts of their links."""
    for part in batches:
        n_best, total = [], []
        for links in part.column("links").to_pylist():
            at = np.searchsorted(pairs, np.frombuffer(links, dtype=code))
            n_best.append(int(best[at].sum()))
            total.append(int(counts[at].sum()))
        keep = [part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(n_best, pa.int64()), pa.array(total, pa.int64())],
                                         ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"])


def aligned_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text",
                      slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links`` per input row.

    ``links`` holds one number ``id of a * size of b's vocabulary + id of b`` per
    link, packed as :attr:`Aligner.code`.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _align_batches(b, (tokenizer_a, tokenizer_b), slice_bytes),
                           "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary")


def pair_counts(aligned: DataFrame, code: str, size_b: int) -> DataFrame:
    """``pair, a, b, n, best``: corpus-wide links per id pair; ``best`` where no other id of a has more with that id of b."""
    counts = aligned.select("links").mapInArrow(lambda b: _pair_batches(b, code), "pair long, n long").groupBy(
        "pair").agg(F.sum("n").alias("n"))
    counts = counts.select("pair", F.expr(f"pair div {size_b}").alias("a"), F.expr(f"pair % {size_b}").alias("b"), "n")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text",
                     slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """How the tokens of two tokenizers line up in every whole text, and how usual its links are in the corpus.

    A (a byte-level ``.json`` file of the tokenizers library) encodes blank + text,
    B (a SentencePiece model that adds that blank itself) the text; special tokens'
    strings are plain text.  Byte ends common to both cut the tokens into groups;
    tokens that end together are linked.

    Columns: ``doc_id, n_a, n_b`` (tokens), ``n_groups, n_links, n_best`` (links
    whose corpus-wide count is the highest of their id of b, ties included),
    ``count_sum`` (the counts over its links), ``groups_sha256`` (digest of
    ``a1,a2|b1;a3|b2,b3``).  One row per input row; texts that are null, empty or
    that B does not keep byte by byte (a written U+2581) have zeros and an empty
    digest.  Ids may be null or repeat (every row counts); other columns are not
    read; an empty table gives an empty result.

    Texts are encoded once; their packed links wait in shared storage until the
    pairs are counted.  The table of counted pairs is broadcast: one token of a
    linked pair ends with the other's bytes, which bounds it by the two
    vocabularies (:func:`possible_pairs`), whatever the corpus.
    """
    spark = docs.sparkSession
    al = aligner(tokenizer_a, tokenizer_b)
    code, size_b = al.code.str, len(al.bytes_b)
    path = scratch_path(spark, "aligned-links")
    aligned_documents(docs, tokenizer_a, tokenizer_b, id_col, text_col, slice_bytes).write.parquet(path)
    aligned = spark.read.parquet(path)
    counted = pair_counts(aligned, code, size_b).select("pair", "n", "best").toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast((counted.column("pair").to_numpy().astype(code), counted.column("n").to_numpy(),
                                          counted.column("best").to_numpy()))
    return aligned.mapInArrow(lambda b: _count_batches(b, code, *known.value),
                              "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                              "n_best long, count_sum long")
