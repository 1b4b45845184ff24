"""Rule bitmask ledger: every quality rule is evaluated once, policies are bit arithmetic over the stored failures.

A ledger row holds a document's measurements and one integer whose bit ``b`` is
set when rule ``b`` fails.  A policy is a named, versioned set of rules; its
verdict is ``failures & mask = 0``.  Ablations (what each rule rejects, alone or
on top of the others) come from the same integers through bitwise aggregation,
without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import (SLICE_BYTES, byte_slices, lines, mix64, sums_by_text, text_buffers,
                                    window_hashes, words)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements; ``bit`` never changes once published."""

    bit: int
    name: str
    fails: str


# Ratios are written as integer comparisons, so every engine decides them alike.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_heavy", "100 * n_symbols > 30 * n_words"),
    Rule(3, "word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    Rule(4, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(5, "many_words", "n_words > 100000"),
)

# A policy lists rule names; a new version is a new entry, old ones stay reproducible.
POLICIES = {
    "base-v1": ("few_words", "repeated_windows"),
    "default-v1": ("few_words", "repeated_windows", "symbol_heavy", "word_length", "duplicate_lines"),
    "strict-v1": ("few_words", "repeated_windows", "symbol_heavy", "word_length", "duplicate_lines", "many_words"),
}


def policy_mask(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[name] for name in POLICIES[policy])


def _covered(h: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Flags of the words that lie in an ``n``-word window found twice or more in their text."""
    flags = np.zeros(len(h), dtype=bool)
    keys = window_hashes(h, n)
    if not len(keys):
        return flags
    inside = text_of[n - 1:] == text_of[:len(keys)]                # windows that stay within a text
    at = np.flatnonzero(inside)
    _, inverse, count = np.unique(mix64(keys[at] ^ mix64(text_of[at].astype(np.uint64) + np.uint64(1))),
                                  return_inverse=True, return_counts=True)
    twice = at[count[inverse] > 1]
    for k in range(n):
        flags[twice + k] = True
    return flags


def _measure_batches(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches, "text", slice_bytes):
        offsets, raw = text_buffers(part.column("text"))
        n = part.num_rows
        w = words(raw, offsets)
        n_words = np.diff(w.bounds)
        letters = np.zeros(len(raw), dtype=bool)
        letters[w.index] = (raw[w.index] & 0xC0) != 0x80           # code points, not bytes
        h = w.hashes(raw)
        text_of = np.repeat(np.arange(n), n_words)
        repeat = sums_by_text(_covered(h, text_of, 3), w.bounds)
        ln = lines(raw, offsets)
        ends = ln.start + ln.length
        has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start + w.length, ln.start, side="right")
        line_of = np.repeat(np.arange(n), np.diff(ln.bounds))[has_word]
        line_key = mix64(ln.hashes(raw)[has_word] ^ mix64(line_of.astype(np.uint64) + np.uint64(1)))
        n_lines = np.bincount(line_of, minlength=n)
        _, first = np.unique(line_key, return_index=True)
        distinct = np.bincount(line_of[first], minlength=n)
        cols = (n_words, sums_by_text(letters, offsets), sums_by_text(_SYMBOL[raw], offsets),
                n_lines - distinct, repeat, n_lines)
        yield pa.RecordBatch.from_arrays([part.column("doc_id")] + [pa.array(c, pa.int64()) for c in cols],
                                         ["doc_id", *MEASURES])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Measurements of every whole text (equality of words, windows and lines by 64-bit hash within a text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _measure_batches(b, slice_bytes),
                           "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    total = F.lit(0).cast("long")
    for r in rules:
        total = total + F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long")
    return total


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **columns) -> DataFrame:
    """``doc_id``, the measurements and ``failures`` (one bit per failed rule), one row per input row.

    Null or empty text has no words and zero measurements; ids may be null or
    repeat (each row is judged by its own text); other columns are not read; an
    empty table gives an empty ledger.
    """
    return measure(docs, **columns).withColumn("failures", failure_bits(rules))


def apply_policy(rows: DataFrame, policy: str, out: str = "kept") -> DataFrame:
    """Add the verdict of a policy version to ledger rows."""
    return rows.withColumn(out, F.col("failures").bitwiseAND(F.lit(policy_mask(policy))) == 0)


def ablation(rows: DataFrame, policy: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents it rejects, documents only it rejects, documents kept without it.

    Ledger rows are first counted per masked failure integer (at most 2^rules
    groups, combined map-side), so the bit tests run on that small table.
    """
    mask = policy_mask(policy, rules)
    counted = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    active = [r for r in rules if r.name in POLICIES[policy]]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                               for r in active]))
    flat = counted.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit")
    return flat.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("rejected"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("rejected_alone"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0))
        .alias("kept_without"))
