"""Chat formatting: layouts are recognised by a schema fingerprint and mapped to canonical turns.

The fingerprint of a record (or of a table) is a hash of its sorted nested
field paths.  Each known fingerprint selects a declarative mapping from paths to
``role`` and ``text``; nothing is guessed from values.  Canonical turns are then
rendered with a template whose control strings cannot occur inside texts: they
are escaped there reversibly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANONICAL = ("conv_id", "turn", "role", "text")
IGNORED = frozenset({"id", "conv_id", "source"})       # identify a record, never part of its layout


@dataclass(frozen=True)
class Layout:
    """``paths`` are the leaf paths; ``turns`` lists (role, text path), a role path if it starts with ``$``."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]


LAYOUTS = (
    Layout("turn_rows", ("turn", "role", "text"), (("$role", "text"),)),
    Layout("messages", ("messages[].role", "messages[].content"), (("$messages[].role", "messages[].content"),)),
    Layout("from_value", ("conversations[].from", "conversations[].value"),
           (("$conversations[].from", "conversations[].value"),)),
    Layout("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", ("instruction", "input", "output"),
           (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_system", ("system", "instruction", "output"),
           (("system", "system"), ("user", "instruction"), ("assistant", "output"))),
    Layout("prompt_response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_system", ("system", "prompt", "response"),
           (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question_answer", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
)
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    """Hash of the sorted distinct leaf paths, identifiers left out."""
    own = sorted({p for p in paths if p.split(".")[0].split("[")[0] not in IGNORED})
    return hashlib.md5("\n".join(own).encode()).hexdigest()


LAYOUT_BY_FINGERPRINT = {fingerprint(x.paths): x for x in LAYOUTS}


def value_paths(value, prefix: str = "") -> Iterator[str]:
    """Leaf paths of a parsed record; list elements share the path ``name[]``."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from value_paths(v, f"{prefix}.{k}" if prefix else k)
    elif isinstance(value, list):
        if not value:
            yield prefix + "[]"
        for v in value:
            yield from value_paths(v, prefix + "[]")
    else:
        yield prefix


def schema_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """Leaf paths of a table schema."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, prefix + "[]")
    else:
        yield prefix


def table_layout(df: DataFrame, columns=None) -> Layout | None:
    """The layout a table's schema selects (of ``columns`` only, if given)."""
    return LAYOUT_BY_FINGERPRINT.get(fingerprint(schema_paths(df.select(*columns).schema if columns else df.schema)))


def _column(value, path: str) -> list:
    """The values at a path, one per list element on the way."""
    found = [value]
    for step in path.split("."):
        name, is_list = step.removesuffix("[]"), step.endswith("[]")
        found = [v.get(name) for v in found]
        if is_list:
            found = [x for v in found for x in (v or [])]
    return found


def _as_text(v) -> str:
    return v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False, sort_keys=True)


def record_turns(record, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of a record under its layout; optional empty fields give no turn."""
    out = []
    for role, path in layout.turns:
        texts = [_as_text(v) for v in _column(record, path)]
        if role.startswith("$"):
            out += [(ROLE_NAMES.get(r, r), t) for r, t in zip(map(_as_text, _column(record, role[1:])), texts)]
        else:
            out += [(role, t) for t in texts if t or role == "assistant"]
    return out


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, raw in zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist()):
            try:
                record = json.loads(raw or "null")
            except ValueError:
                record = None
            mark = fingerprint(value_paths(record)) if isinstance(record, dict) else None
            layout = LAYOUT_BY_FINGERPRINT.get(mark)
            turns = record_turns(record, layout) if layout else [(None, None)]
            rows += [(conv_id, k if layout else None, r, t, mark, layout.name if layout else None)
                     for k, (r, t) in enumerate(turns)]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
        cols = list(zip(*rows)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         [*CANONICAL, "fingerprint", "layout"])


def turns_from_records(records: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """Canonical turns of JSON records in mixed layouts: ``conv_id, turn, role, text, fingerprint, layout``.

    A record whose fingerprint is unknown, or that is null or not a JSON object,
    gives one row with a null layout, so nothing vanishes.
    """
    rows = records.select(F.col(id_col).cast("long").alias("conv_id"), F.col(record_col).cast("string").alias("record"))
    return rows.mapInArrow(_record_batches, "conv_id long, turn long, role string, text string, "
                                            "fingerprint string, layout string")


def turns_from_table(df: DataFrame, id_col: str = "conv_id", columns=None) -> DataFrame:
    """Canonical turns of a table whose schema fingerprint selects a layout.

    ``columns`` restricts the fingerprint to those columns (for tables with extra
    ones).  Column expressions only; an unknown fingerprint is an error.
    """
    layout = table_layout(df, columns)
    if layout is None:
        raise ValueError(f"no layout for field paths {sorted(set(schema_paths(df.schema)))}")
    conv = F.col(id_col).cast("long").alias("conv_id")
    if layout.name == "turn_rows":
        return df.select(conv, F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                         F.col("text").cast("string").alias("text"))
    (role, text), *rest = layout.turns
    if role.startswith("$"):
        name = text.split("[]")[0]
        ex = df.select(conv, F.posexplode(name).alias("turn", "m"))
        out = ex.select("conv_id", F.col("turn").cast("long"), F.col("m." + role.split("[].")[1]).alias("role"),
                        F.col("m." + text.split("[].")[1]).alias("text"))
        known = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
        return out.withColumn("role", F.coalesce(known[F.col("role")], F.col("role")))
    each = F.filter(F.array(*[F.struct(F.lit(r).alias("role"), F.coalesce(F.col(t).cast("string"), F.lit("")).alias("text"))
                              for r, t in layout.turns]),
                    lambda x: (x["text"] != "") | (x["role"] == "assistant"))
    return df.select(conv, F.posexplode(each).alias("turn", "m")).select(
        "conv_id", F.col("turn").cast("long"), "m.role", "m.text")


# ---------------------------------------------------------------- template
# Control strings of the template and of common chat templates; all are escaped inside texts.
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"
_ESCAPE = r"(<|\[)(\\*)" + _CONTROL
_UNESCAPE = re.compile(r"(<|\[)\\(\\*)" + _CONTROL)


def escape(col):
    """One more backslash after the first character of every control string (column expression)."""
    return F.regexp_replace(col, _ESCAPE, r"$1\\$2")


def escape_text(s: str) -> str:
    return re.sub(_ESCAPE, r"\1\\\2", s)


def unescape_text(s: str) -> str:
    return _UNESCAPE.sub(r"\1\2", s)


def _role_out(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape_text(s))


def format_turns(turns: DataFrame) -> DataFrame:
    """Render canonical turns, one segment per turn: ``conv_id, turn, segment, loss_begin, loss_end``.

    The formatted conversation is its segments in order of ``(turn, segment)``.
    One row per turn keeps a conversation of any length from becoming one value.
    ``[loss_begin, loss_end)`` are the code points of the segment under the loss
    mask: the (escaped) text of assistant turns.  Null roles and texts render as
    empty; null turns sort first; turns with equal numbers go by segment.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    role_out = escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    head = F.concat(F.lit(BEGIN), role_out, F.lit("\n"))
    body = escape(F.coalesce(F.col("text"), F.lit("")))
    begin = F.char_length(head)
    learn = role == "assistant"
    return turns.select(
        F.col("conv_id"), F.col("turn"), F.concat(head, body, F.lit(END)).alias("segment"),
        F.when(learn, begin).otherwise(0).cast("long").alias("loss_begin"),
        F.when(learn, begin + F.char_length(body)).otherwise(0).cast("long").alias("loss_end"))


def parse_segment(segment: str) -> tuple[str, str]:
    """(role, text) back from a segment."""
    if not (segment.startswith(BEGIN) and segment.endswith(END)):
        raise ValueError("not a segment of this template")
    role, text = segment[len(BEGIN):-len(END)].split("\n", 1)
    return _role_out(role), unescape_text(text)


class _Conversation:
    """Running digests of one conversation; constant memory whatever its length."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, begin: int, end: int) -> None:
        role, text = parse_segment(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = unescape_text(segment[begin:end])
        self.loss_chars += len(learned)
        self.loss.update(learned.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    now = None
    for batch in batches:
        done = []
        for conv_id, segment, begin, end in zip(*(batch.column(c).to_pylist() for c in
                                                  ("conv_id", "segment", "loss_begin", "loss_end"))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv_id)
            now.add(segment, begin, end)
        if done:
            yield out(done)
    if now is not None:
        yield out([now.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every formatted conversation, parsed back from its segments.

    A conversation is hashed in order, so its segments meet in one task; they
    stream through it sorted (Spark's sort spills) and only running digests are
    held.  A null ``conv_id`` is a conversation of its own.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.select("conv_id", "segment", "loss_begin", "loss_end").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                    "loss_sha256 string, formatted_chars long")
