"""SentencePiece encoding that keeps the way back to the source bytes, and decoding.

Normalisation follows the model's compiled character map: at every source
position the longest matching prefix is replaced, and each normalised byte
remembers the source byte it came from.  Pieces are cut from the normalised
text, so their normalised lengths project onto source byte spans.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import SLICE_BYTES, byte_slices, text_buffers
from kestrel.llm.tables import tokenizer_file
from kestrel.llm.token_cache import WordMemo

MARK = "▁"                       # the visible blank that stands for a space in pieces
_MARK = MARK.encode()
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 and its replacement strings.

    Layout (a fixed public format): a little-endian 32-bit size of the trie in
    bytes, the trie's 32-bit units, then NUL-terminated replacements; a leaf's
    value is the offset of its replacement.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if blob else []
        self.strings = blob[4 + size:] if blob else b""

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest mapped prefix at ``at``."""
        units, best = self.units, None
        node = _child_base(units[0], 0)
        for k in range(at, len(raw)):
            node ^= raw[k]
            if node >= len(units) or units[node] & 0x800000FF != raw[k]:
                break
            unit = units[node]
            node = _child_base(unit, node)
            if unit >> 8 & 1:
                best = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        end = self.strings.index(b"\0", best[1])
        return best[0], self.strings[best[1]:end]


def _child_base(unit: int, node: int) -> int:
    """Where a unit's children start: its 22-bit offset, shifted by 8 if bit 9 is set."""
    return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))


def _char_size(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    """Longest-prefix normalisation with source alignment."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool, suffix: bool):
        self.map = CharMap(charsmap)
        self.dummy_prefix, self.squeeze, self.suffix = dummy_prefix, squeeze, suffix
        self.blank = _MARK if escape else b" "

    def normalize(self, raw: bytes) -> tuple[bytes, list[int]]:
        """(normalised bytes, source offset of each of them plus the end offset)."""
        parts: list[tuple[int, int, bytes]] = []                   # source start, end, replacement
        at = 0
        while at < len(raw):
            hit = self.map.longest(raw, at) if self.map else None
            size, new = hit or ((n := _char_size(raw[at])), raw[at:at + n])
            parts.append((at, at + size, new))
            at += size
        if self.squeeze:                                           # leading blanks go
            k = 0
            while k < len(parts) and parts[k][2] in (b" ", b""):
                k += 1
            parts = parts[k:]
        if not parts:
            return b"", [0]
        out, source = bytearray(), []

        def put(piece: bytes, start: int, step: int = 0) -> None:
            out.extend(piece)
            source.extend(start + step * k for k in range(len(piece)))
        if self.dummy_prefix and not self.suffix:
            put(self.blank, parts[0][0])
        blank_before, end = self.squeeze, parts[0][0]
        for start, stop, new in parts:
            while blank_before and new[:1] == b" ":
                new = new[1:]
            if new:
                kept, at = new == raw[start:stop], start
                for char in _characters(new):
                    if char == b" ":
                        put(self.blank, at)
                    else:
                        put(char, at, int(kept))                   # unchanged bytes keep their own place
                    at += len(char) * kept
                blank_before = new[-1:] == b" "
            end = stop
            if not self.squeeze:
                blank_before = False
        if self.squeeze:                                           # trailing blanks go
            while out.endswith(self.blank):
                del out[-len(self.blank):]
                end = source[len(out)]
                del source[len(out):]
        if self.dummy_prefix and self.suffix:
            put(self.blank, end)
        source.append(end)
        return bytes(out), source


def _characters(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        n = _char_size(raw[at])
        yield raw[at:at + n]
        at += n


class PieceCodec:
    """A SentencePiece model: ids, source byte spans and decoded text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        model = schema.ModelProto()
        model.ParseFromString(self.sp.serialized_model_proto())
        spec, trained = model.normalizer_spec, model.trainer_spec
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix,
                                     spec.remove_extra_whitespaces, spec.escape_whitespaces,
                                     trained.treat_whitespace_as_suffix)
        kinds = schema.ModelProto.SentencePiece
        silent = (kinds.CONTROL, kinds.UNKNOWN)
        self.sizes = np.array([1 if p.type == kinds.BYTE else 0 if p.type in silent else len(p.piece.encode())
                               for p in model.pieces], dtype=np.int64)
        self.unknown = self.sp.unk_id()
        self.begin, self.end = self.sp.bos_id(), self.sp.eos_id()
        # Words may be encoded apart when nothing is rewritten and no piece runs on into a next word.
        self.by_word = (not self.normalizer.map and spec.add_dummy_prefix and spec.escape_whitespaces
                        and not spec.remove_extra_whitespaces and not trained.treat_whitespace_as_suffix
                        and trained.byte_fallback and self.sp.piece_to_id(MARK) != self.unknown
                        and not any(p.type == kinds.USER_DEFINED or MARK in p.piece.lstrip(MARK) for p in model.pieces))
        self._memo = WordMemo(self._encode_words, 200_000)

    def _encode_words(self, chunks: list[str]) -> list[bytes]:
        plain = [c.replace(MARK, " ") for c in chunks]
        found = self.sp.encode(plain, num_threads=1)
        lone = [self.sp.piece_to_id(MARK)]                         # the library adds no blank to an empty word
        return [np.array(ids if c else lone, dtype="<u4").tobytes() for c, ids in zip(chunks, found)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without begin and end."""
        if not self.by_word:
            return [np.array(ids, dtype="<u4") for ids in self.sp.encode(texts, num_threads=1)]
        split = [self._chunks(t) for t in texts]
        known = self._memo.lookup(set().union(*split))
        return [np.frombuffer(b"".join(map(known.__getitem__, c)), dtype="<u4") for c in split]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """Words as the library would see them behind their blank; a run of blanks stays with its word."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return [c[1:] for c in _CHUNK.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def spans(self, raw: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) source byte of every piece; ends are exclusive, inserted blanks are empty."""
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.by_word:
            edges = np.concatenate(([0], np.cumsum(self.sizes[ids])))
            blanks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x20)
            # normalised = inserted blank (3 bytes), then the source with each blank widened by 2
            before = np.searchsorted(blanks + len(_MARK) + 2 * np.arange(len(blanks)), edges, side="left")
            source = np.maximum(edges - len(_MARK), 0) - 2 * before
        else:
            text, align = self.normalizer.normalize(raw)
            source = np.array(align, dtype=np.int64)[self._edges(text, ids)]
        return source[:-1], source[1:]

    def _edges(self, normalized: bytes, ids: np.ndarray) -> np.ndarray:
        """Normalised offsets between pieces; an unknown piece lasts until the next known one fits."""
        at, edges = 0, [0]
        pieces = [self.sp.id_to_piece(int(i)).encode() for i in ids]
        for k, i in enumerate(ids):
            if i != self.unknown:
                at += int(self.sizes[i])
            elif k + 1 == len(ids):
                at = len(normalized)
            else:
                at = normalized.find(pieces[k + 1], at + _char_size(normalized[at]))
            edges.append(at)
        return np.array(edges)

    def decode(self, ids: np.ndarray) -> str:
        return self.sp.decode(ids.tolist())


@functools.lru_cache(maxsize=2)
def codec(name: str) -> PieceCodec:
    """The codec of a model file (installed public name or absolute path), kept by the Python worker."""
    return PieceCodec(name if os.path.isabs(name) else tokenizer_file(name))


def _rows(batches: Iterator[pa.RecordBatch], model: str, slice_bytes: int):
    """(slice, per text: raw bytes, ids with begin and end, span begins, span ends)."""
    c = codec(model)
    for part in byte_slices(batches, "text", slice_bytes):
        offsets, raw = text_buffers(part.column("text"))
        blobs = [raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        found = []
        for blob, inner in zip(blobs, c.encode([b.decode("utf-8", "replace") for b in blobs])):
            begin, end = c.spans(blob, inner)
            ids = np.concatenate(([c.begin], inner, [c.end])).astype("<u4")
            # begin and end ids cover nothing
            found.append((blob, ids, np.concatenate(([0], begin, [len(blob)])), np.concatenate(([0], end, [len(blob)]))))
        yield part, found


def _encode_batches(batches, model, slice_bytes):
    for part, found in _rows(batches, model, slice_bytes):
        ids = pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32()))
        begin = pa.array([f[2] for f in found], pa.list_(pa.int64()))
        end = pa.array([f[3] for f in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, begin, end],
                                         ["doc_id", "ids", "span_begin", "span_end"])


def _digest_batches(batches, model, slice_bytes):
    c, sha = codec(model), lambda x: hashlib.sha256(x).hexdigest()
    for part, found in _rows(batches, model, slice_bytes):
        out = []
        for blob, ids, begin, end in found:
            spans = np.stack((begin, end), 1).astype("<u4").tobytes()
            out.append((len(ids), sha(ids.tobytes()), sha(c.decode(ids).encode("utf-8", "surrogatepass")),
                        len(blob), int((end - begin).sum()), sha(spans)))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2]),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5])],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "covered_bytes", "spans_sha256"])


def _decode_batches(batches, model):
    c = codec(model)
    for batch in batches:
        texts = [c.decode(np.array(ids or [], dtype=np.int64)) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Ids (begin and end included) and source byte spans of every whole text.

    Columns ``doc_id, ids, span_begin, span_end``; the three arrays run in
    parallel, ends are exclusive, begin and end ids cover nothing.  One row per
    input row; null text encodes as empty (begin and end only); ids may be null
    or repeat; other columns are not read; an empty table gives an empty result.
    """
    return _texts(docs, id_col, text_col).mapInArrow(
        lambda b: _encode_batches(b, model, slice_bytes),
        "doc_id long, ids array<int>, span_begin array<long>, span_end array<long>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids`` as the library decodes them; null ids decode as empty."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: _decode_batches(b, model), "doc_id long, text string")


def encode_decode_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                          slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Digests of encoding and decoding every whole text, in one pass and without storing ids.

    ``doc_id, n_tokens, ids_sha256`` (little-endian unsigned 32-bit ids),
    ``decoded_sha256`` (UTF-8 of the decoded text), ``n_bytes``, ``covered_bytes``
    (source bytes under pieces), ``spans_sha256`` (begin, end per id as unsigned
    32-bit).  Edge cases as in :func:`encode`.
    """
    return _texts(docs, id_col, text_col).mapInArrow(
        lambda b: _digest_batches(b, model, slice_bytes),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
        "n_bytes long, covered_bytes long, spans_sha256 string")
