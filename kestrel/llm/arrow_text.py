"""Byte-level helpers for text columns inside Arrow map functions.

A text column arrives as Arrow record batches.  These helpers cut a batch into
slices of a bounded number of UTF-8 bytes (so working memory follows bytes, not
rows) and hash words or lines of a slice in a few vectorised passes, without a
Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

# Words are runs of bytes other than space and \t \n \v \f \r.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd 64-bit multipliers of the polynomial hashes (arbitrary, fixed for reproducible results).
_BASE = 0x9E3779B97F4A7C15
_FAR_BASE = 0xC2B2AE3D27D4EB4F
_BYTE_CODE = np.random.default_rng(20240607).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NEAR = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_NEAR_POWERS = _powers(_BASE, _NEAR)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; a null reads as an empty text."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def byte_slices(batches: Iterator[pa.RecordBatch], text: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding at most ``max_bytes`` of ``text`` each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = text_buffers(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


class Runs:
    """Maximal runs of selected bytes, never crossing a text boundary."""

    def __init__(self, keep: np.ndarray, offsets: np.ndarray):
        self.index = np.flatnonzero(keep)
        first = np.zeros(len(keep) + 1, dtype=bool)
        first[offsets[:-1]] = True
        opens = keep.copy()
        opens[1:] &= ~keep[:-1] | first[1:len(keep)]
        self.start = np.flatnonzero(opens)
        self.begin = np.searchsorted(self.index, self.start)            # in the compacted bytes
        self.length = np.diff(np.append(self.begin, len(self.index)))
        self.bounds = np.searchsorted(self.start, offsets)              # runs of text d: bounds[d]:bounds[d+1]

    def hashes(self, raw: np.ndarray) -> np.ndarray:
        """64-bit hash of every run's bytes and length."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        pos = np.arange(len(self.index)) - np.repeat(self.begin, self.length)
        longest = int(self.length.max())
        code = _BYTE_CODE[raw[self.index]]
        if longest <= _NEAR:
            code = code * _NEAR_POWERS[pos]
        else:
            far = _powers(_FAR_BASE, longest // _NEAR + 1)
            code = code * _NEAR_POWERS[pos % _NEAR] * far[pos // _NEAR]
        return mix64(np.add.reduceat(code, self.begin) ^ (self.length.astype(np.uint64) * np.uint64(_FAR_BASE)))


def words(raw: np.ndarray, offsets: np.ndarray) -> Runs:
    """The words (runs free of ASCII white space) of every text."""
    return Runs(~_SPACE[raw], offsets)


def lines(raw: np.ndarray, offsets: np.ndarray) -> Runs:
    """The non-empty \\n-separated lines of every text."""
    return Runs(raw != 0x0A, offsets)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` consecutive values of ``h``; order matters."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for k in range(n):
        out += h[k:len(h) - n + 1 + k]
        out *= np.uint64(_BASE)
    return mix64(out ^ np.uint64(n))


def sums_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in every text (offsets in units of flags)."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]
