"""How far the sources of a language drift apart in their use of terms.

Every (language, source) group is held as sorted (term id, count) arrays, cut
into blocks of term ids.  Each unordered pair of a language's groups is one
task per block: the two arrays are co-grouped, the shorter gallops through the
longer, and terms that both, one or neither of them holds are priced.  The
difference is symmetric, so one merge gives both directions.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import SLICE_BYTES, byte_slices, lower_ascii, text_buffers
from kestrel.session import scratch_path

SCALE = 1_000_000_000           # probabilities are whole billionths
SMOOTHING = 5                   # added to every count
HELD_TERMS = 600_000            # (group, term) counts a task holds before it hands them on
ROW_TERMS = 20_000              # terms of one row that leaves the task
BLOCK_TERMS = 32_768            # about the term ids of one block, which bounds the arrays of a pair task
GALLOP = 64                     # ids that gallop together

# A term is a run of bytes that are ASCII letters or belong to a character beyond ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# ---------------------------------------------------------------- counting
def _terms(text: bytes, slice_bytes: int):
    """The terms of a text as a list, or, of a long one, as distinct terms with counts."""
    if len(text) <= slice_bytes:
        return _TERM.findall(text)
    return Counter(m.group() for m in _TERM.finditer(text))


def _count_batches(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, source, terms, counts``: occurrences of terms in a group, or, with a null source, their documents.

    Every group has a row, with or without terms.
    """
    held, docs = defaultdict(Counter), defaultdict(Counter)

    def rows():
        for (lang, source), found in [*held.items(), *(((lang, None), d) for lang, d in docs.items())]:
            terms, counts = pa.array(list(found), pa.binary()).cast(pa.string()), np.fromiter(found.values(), np.int64, len(found))
            for k in range(0, max(len(counts), 1), ROW_TERMS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([source], pa.string()), _as_list(terms[k:k + ROW_TERMS]),
                     _as_list(pa.array(counts[k:k + ROW_TERMS]))], ["lang", "source", "terms", "counts"])

    for part in byte_slices(batches, "text", slice_bytes):
        offsets, raw = text_buffers(part.column("text"))
        raw = lower_ascii(raw)
        found = defaultdict(list)
        for lang, source, a, b in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(),
                                      offsets[:-1], offsets[1:]):
            found[lang, source].append(_terms(raw[a:b].tobytes(), slice_bytes))
        for group, texts in found.items():
            count(held[group], texts)
        for lang in {lang for lang, _ in found}:
            docs[lang].update(chain.from_iterable(map(set, chain.from_iterable(t for g, t in found.items() if g[0] == lang))))
        if sum(map(len, held.values())) > HELD_TERMS:
            yield from rows()
            held.clear()
            docs.clear()
    if held:
        yield from rows()


def count(total: Counter, texts: list) -> None:
    """Add the terms of texts, each a list of terms or a counter."""
    total.update(chain.from_iterable(t for t in texts if isinstance(t, list)))
    for t in texts:
        if isinstance(t, Counter):
            total.update(t)


def _as_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``lang, source, term, n``: occurrences of every term in every group; of rows with a null source, its documents.

    A term is a run of letters A-Z, a-z or of characters beyond ASCII, with only
    A-Z lower-cased.  Every occurring group has one row with a null term.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counted = rows.mapInArrow(lambda b: _count_batches(b, slice_bytes),
                              "lang string, source string, terms array<string>, counts array<long>")
    # one empty entry a row for the group itself
    entries = F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), "terms").alias("term"),
                           F.concat(F.array(F.lit(0).cast("long")), "counts").alias("n"))
    return counted.select("lang", "source", F.inline(entries)).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- pricing
def prices(count: np.ndarray | int, total: int, kept: int):
    """``1 + floor(SCALE * (count + 5) / (total + 5 * kept))``, in 64 bits while the divisor is below 9e15."""
    divisor = total + SMOOTHING * kept
    price, rest = np.divmod(np.asarray(count, dtype=np.int64) + SMOOTHING, divisor)
    for _ in range(3):                                             # three decimal digits a step
        digits, rest = np.divmod(rest * 1000, divisor)
        price = price * 1000 + digits
    return price + 1


def _price(count: Column, total: Column, kept: Column) -> Column:
    """The same in SQL."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(20,0)")
    return F.call_function("div", scaled, (total + SMOOTHING * kept).cast("decimal(20,0)")) + 1


def galloping_bounds(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``needles`` would go in the sorted ``hay``.

    The reach doubles from the place of the last find until it passes the next
    needles, which are then placed inside it, so a few needles cost the logarithm
    of the gaps between them and not the length of ``hay``.
    """
    out, low = np.empty(len(needles), dtype=np.int64), 0
    for k in range(0, len(needles), GALLOP):
        part, reach = needles[k:k + GALLOP], GALLOP
        while low + reach < len(hay) and hay[low + reach] < part[-1]:
            reach *= 2
        out[k:k + GALLOP] = low + np.searchsorted(hay[low:low + reach + 1], part)
        low = int(out[min(k + GALLOP, len(needles)) - 1])
    return out


def merge_pair(ids_a: np.ndarray, counts_a: np.ndarray, total_a: int,
               ids_b: np.ndarray, counts_b: np.ndarray, total_b: int, kept: int) -> tuple[int, int]:
    """(terms that either group holds, sum of their absolute price differences) of two sorted sparse arrays."""
    if len(ids_a) > len(ids_b):
        ids_a, counts_a, total_a, ids_b, counts_b, total_b = ids_b, counts_b, total_b, ids_a, counts_a, total_a
    a, b = prices(counts_a, total_a, kept), prices(counts_b, total_b, kept)
    none_a, none_b = int(prices(0, total_a, kept)), int(prices(0, total_b, kept))
    at = galloping_bounds(ids_a, ids_b)
    both = np.zeros(len(ids_a), dtype=bool)
    if len(ids_b):
        both = (at < len(ids_b)) & (ids_b[np.minimum(at, len(ids_b) - 1)] == ids_a)
    only_b = np.ones(len(ids_b), dtype=bool)
    only_b[at[both]] = False
    value = (np.abs(a[both] - b[at[both]]).sum()                   # overlaps
             + np.abs(a[~both] - none_b).sum() + np.abs(b[only_b] - none_a).sum())      # one-sided terms
    return len(ids_a) + int(only_b.sum()), int(value)


def _pair_task(left: pa.Table, right: pa.Table) -> pa.Table:
    known = (left if left.num_rows else right).select(["lang", "a", "b", "total_a", "total_b", "kept"]).to_pylist()[0]

    def side(table):
        if not table.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(table.column(c)[0].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ids", "counts"))
    held, value = merge_pair(*side(left), known["total_a"], *side(right), known["total_b"], known["kept"])
    return pa.table({"lang": [known["lang"]], "a": [known["a"]], "b": [known["b"]], "held": [held], "value": [value]})


class SourceAudit:
    """Kept terms, groups and their sparse arrays of one documents table, in shared storage."""

    def __init__(self, docs: DataFrame, least_docs: int = 30, block_terms: int = BLOCK_TERMS, **columns: str):
        counts = _written(term_counts(docs, **columns), "audit-counts")
        n = F.col("n")
        kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
            F.sum(F.when(F.col("source").isNotNull(), n)).alias("lang_n"),
            F.sum(F.when(F.col("source").isNull(), n)).alias("docs")).where(F.col("docs") >= least_docs)
        kept = _written(kept.drop("docs"), "audit-kept")
        counts = counts.where("source IS NOT NULL")
        sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        blocks = -(-(sizes.agg(F.max("kept")).first()[0] or 0) // block_terms) or 1     # one number for all languages
        block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
        place = Window.partitionBy("lang", "block").orderBy("term")
        numbered = kept.withColumn("block", block).withColumn("id", F.row_number().over(place))
        #: lang, source, term, n, lang_n, block, id: what each group holds of the kept terms
        self.held = _written(counts.where("term IS NOT NULL").join(numbered, ["lang", "term"]).select(
            "lang", "source", "term", "n", "lang_n", "block", "id"), "audit-held")
        totals = self.held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        zero = F.lit(0).cast("long")
        #: lang, source, total, kept, lang_total: every group, also without terms
        self.groups = _written(
            counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left")
            .join(sizes, "lang", "left").select("lang", "source", *(F.coalesce(c, zero).alias(c)
                                                                    for c in ("total", "kept", "lang_total"))), "audit-groups")

    def arrays(self) -> DataFrame:
        """``lang, source, block, ids, counts``: sorted arrays of at most about ``block_terms`` terms."""
        entries = F.array_sort(F.collect_list(F.struct("id", "n")))
        packed = self.held.groupBy("lang", "source", "block").agg(entries.alias("e"))
        return packed.select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("counts"))

    def pair_values(self) -> DataFrame:
        """``lang, source, item, value``: both directions of every pair of a language's sources."""
        g = self.groups
        pairs = _written(g.alias("l").join(g.alias("r"), (F.col("l.lang") == F.col("r.lang"))
                                           & (F.col("l.source") < F.col("r.source")))
                         .select("l.lang", F.col("l.source").alias("a"), F.col("r.source").alias("b"), "l.kept",
                                 F.col("l.total").alias("total_a"), F.col("r.total").alias("total_b")), "audit-pairs")
        arrays = _written(self.arrays(), "audit-arrays")
        keys = ["lang", "a", "b", "block"]
        columns = [*keys, "kept", "total_a", "total_b", "ids", "counts"]
        left, right = (arrays.withColumnRenamed("source", end).join(pairs, ["lang", end]).select(*columns).toDF(*columns)
                       for end in ("a", "b"))                      # new columns, so that the two sides can be told apart
        merged = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            _pair_task, "lang string, a string, b string, held long, value long")
        merged = merged.groupBy("lang", "a", "b").agg(F.sum("held").alias("held"), F.sum("value").alias("value"))
        zero = F.lit(0).cast("long")
        absent = F.abs(_price(zero, F.col("total_a"), F.col("kept")) - _price(zero, F.col("total_b"), F.col("kept")))
        value = F.when(F.col("kept") == 0, zero).otherwise(           # terms that neither group holds
            F.coalesce("value", zero) + (F.col("kept") - F.coalesce("held", zero)) * absent)
        both = pairs.join(merged, ["lang", "a", "b"], "left").select("lang", "a", "b", value.alias("value"))
        return both.select("lang", "value", F.explode(F.array(
            F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
            F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way")).select(
                "lang", "way.source", "way.item", "value")

    def term_values(self) -> DataFrame:
        """``lang, source, item, value``: terms a group uses more than its language does, and by how much."""
        p = _price(F.col("n"), F.col("total"), F.col("kept"))
        q = _price(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
        return self.held.join(self.groups, ["lang", "source"]).select(
            "lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")


def audit_sources(docs: DataFrame, least_docs: int = 30, top_terms: int = 50, block_terms: int = BLOCK_TERMS,
                  lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Divergence of every (language, source) group from its language's other sources and from the language.

    ``lang, source, part, item, value, rank``.  A language keeps the terms found
    in at least ``least_docs`` of its documents (rows).  With N a group's
    occurrences of kept terms and V their number, a term's price is
    ``1 + floor(1e9 * (count + 5) / (N + 5 V))``.  Part ``pair``: the sum over all
    kept terms of the price differences to each other source (0 without kept
    terms).  Part ``term``: the ``top_terms`` terms that the group holds and
    prices above its language, with the difference.  Ranks go by value, then by
    the item's UTF-8.

    Null language, source or text reads as empty; repeated rows count each; a
    group without terms still has its pairs; an empty table gives an empty
    result; other columns are not read.  All arithmetic is in whole numbers.
    """
    audit = SourceAudit(docs, least_docs, block_terms, lang_col=lang_col, source_col=source_col, text_col=text_col)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = []
    for part, rows in (("pair", audit.pair_values()), ("term", audit.term_values())):
        ranked = rows.withColumn("rank", F.row_number().over(order))
        if part == "term":
            ranked = ranked.where(F.col("rank") <= top_terms)
        parts.append(ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank"))
    return parts[0].unionAll(parts[1])
