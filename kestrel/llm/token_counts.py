"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import SLICE_BYTES, byte_slices, text_buffers
from kestrel.llm.tables import tokenizer_file
from kestrel.llm.token_cache import WordMemo

_ASCII_SPACE = b" \t\n\x0b\x0c\r"


def safe_pieces(raw: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """Pieces of about ``limit`` bytes, cut only after ASCII white space.

    No token spans white space in the tokenizers counted here, so the counts of
    the pieces add up to the count of the text.  A run without white space is
    never cut, whatever its length.
    """
    start = 0
    while len(raw) - start > limit:
        stop = start + limit
        cut = max(raw.rfind(bytes([c]), start, stop) for c in _ASCII_SPACE) + 1
        if cut <= start:
            ahead = [p for p in (raw.find(bytes([c]), stop) for c in _ASCII_SPACE) if p >= 0]
            if not ahead:
                break
            cut = min(ahead) + 1
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def _json_counter(path: str) -> WordMemo:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    def count(missing: list[bytes]) -> list[int]:
        texts = [w.decode("utf-8", "replace") for w in missing]
        return [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    return WordMemo(count)


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> WordMemo:
    """The counter of a tokenizer file, kept by the Python worker."""
    return _json_counter(path)


def _count_batches(batches: Iterator[pa.RecordBatch], name: str, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # one core per task is Spark's to give
    memo = _counter(name if os.path.isabs(name) else tokenizer_file(name))
    for part in byte_slices(batches, "text", slice_bytes):
        offsets, raw = text_buffers(part.column("text"))
        sizes, counts = [], []
        texts = [raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        if len(raw) <= slice_bytes:
            split = [t.split() for t in texts]
            known = memo.lookup(set().union(*split))
            counts = [sum(map(known.__getitem__, w)) for w in split]
        else:                                                      # one long text
            for t in texts:
                n = 0
                for piece in safe_pieces(t, slice_bytes):
                    w = piece.split()
                    n += sum(map(memo.lookup(set(w)).__getitem__, w))
                counts.append(n)
        sizes = (offsets[1:] - offsets[:-1])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Bytes and tokens of every text, one row per input row.

    ``tokenizer`` is a ``.json`` file of the tokenizers library (an installed
    public name or an absolute path) whose pre-tokenizer drops white space, so
    each white-space-free word is counted once per memo and the counts add up.
    Only lengths leave the Arrow function.  Working memory is bounded by
    ``slice_bytes`` of text plus the memo, not by rows; a longer text is split
    after white space.

    Columns: ``doc_id`` (as given, null allowed), ``n_bytes`` (UTF-8), ``n_tokens``
    (no begin, end or added tokens), ``over_limit`` (``n_tokens > limit``).  Null
    text counts as empty (0, 0, false); repeated ids keep one row each; other
    columns of the input, whatever their names, are not read; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(lambda b: _count_batches(b, tokenizer, slice_bytes),
                              "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
