"""Personal data by fixed shapes and by bootstrapped contextual extraction, in DataFrame expressions only.

Base kinds are patterns with a check.  On top of them, seed entities (the base
matches) induce lexical patterns: the word, or the two words, that stand before
an identifier.
Patterns and the identifier tokens they introduce form a bipartite graph whose
scores are refined in rounds; tokens that no base kind found, but that
high-confidence patterns introduce, become spans of kind ``context``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.tables import fresh_names, named
from kestrel.session import scratch_path

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("context",)

# Fixed shapes. Possessive quantifiers and the anchors change no match, only its cost: a run that fails at its
# start fails at every later start, and nothing after a run can take back part of it.
_LOCAL = r"[A-Za-z0-9._%+-]"
SHAPES = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these cannot hold the kind.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# An identifier token: a run free of white space that holds a digit or an at sign.
_TOKEN = r"(?<![^\s])[^\s0-9@]*+[0-9@][^\s]*+"


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body`` of the value, evaluated once (a column used inside a lambda would be evaluated per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(a: Column, start: Column, step) -> Column:
    empty = F.array().cast("array<bigint>")
    return F.aggregate(
        a, F.struct(start.alias("total"), empty.alias("out")),
        lambda acc, x: F.struct(step(acc["total"], x).alias("total"),
                                F.concat(acc["out"], F.array(step(acc["total"], x))).alias("out")),
        lambda acc: acc["out"])


def prefix_fold(values: Column, step, block: int = 128) -> Column:
    """Running totals of an array of longs of 0 or more under an associative ``step`` that 0 does not change.

    Arrays grow by copying, so long ones are folded in blocks: the cost per value
    is that of a block, not of the whole array.
    """
    zero = F.lit(0).cast("long")

    def blocked(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")),
                             lambda b: F.slice(v, b * block + 1, block))
        return let(blocks, lambda bs: let(
            _running(F.transform(bs, lambda b: F.aggregate(b, zero, step)), zero, step),
            lambda totals: F.flatten(F.transform(bs, lambda b, i: _running(
                b, F.when(i > 0, F.get(totals, i - 1)).otherwise(zero), step)))))
    return let(values, lambda v: F.when(F.size(v) <= block, _running(v, zero, step)).otherwise(blocked(v)))


def prefix_sums(values: Column, block: int = 128) -> Column:
    """Running sums of an array of longs."""
    return prefix_fold(values, lambda a, b: a + b, block)


def prefix_max(values: Column, block: int = 128) -> Column:
    """Running maxima of an array of longs of 0 or more."""
    return prefix_fold(values, lambda a, b: F.greatest(a, b), block)


def match_spans(text: Column, shape: str, with_before: bool = False) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<s, e, m>>`` in code points, end exclusive.

    ``with_before`` adds ``b``, the text between the previous match and this one.
    """
    found = F.regexp_extract_all(text, F.lit(shape), F.lit(0))
    between = F.split(text, shape, -1)                             # one more piece than matches

    def placed(v: Column) -> Column:
        steps = F.transform(v["found"], lambda m, i: (F.char_length(v["between"][i]) + F.when(
            i > 0, F.char_length(v["found"][i - 1])).otherwise(0)).cast("long"))

        def spans(starts: Column) -> Column:
            def one(m, i):
                fields = [starts[i].alias("s"), (starts[i] + F.char_length(m)).alias("e"), m.alias("m")]
                if with_before:
                    fields.append(v["between"][i].alias("b"))
                return F.struct(*fields)
            return F.transform(v["found"], one)
        return let(prefix_sums(steps), spans)
    return let(F.struct(found.alias("found"), between.alias("between")), placed)


def _luhn(digits: Column) -> Column:
    d = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda c: c.cast("int"))
    total = F.aggregate(
        F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)),
        F.lit(0), lambda s, x: s + x)
    return total % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        bare = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(bare, lambda p: F.when(F.char_length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        n = F.char_length(digits)
        return F.when((n >= 13) & (n <= 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The kind's checked matches; failing matches are dropped, not retried."""
    none = F.array().cast("array<struct<s:bigint,e:bigint,m:string>>")
    hint = HINTS[kind]
    could = text.contains(hint) if hint else text.rlike("[0-9][\\x20-]?[0-9]")
    if kind in ("ip", "phone"):
        could = could & text.rlike("[0-9]")
    return F.when(could, F.filter(match_spans(text, SHAPES[kind]), lambda x: _passes(kind, x["m"]))).otherwise(none)


# ---------------------------------------------------------------- contexts
@dataclass(frozen=True)
class Bootstrap:
    """Parameters of the extraction.

    A pattern needs ``min_seeds`` distinct seed identifiers and a confidence of
    ``min_confidence``; a token needs a score of ``min_score``.
    """

    rounds: int = 3
    min_seeds: int = 5
    min_confidence: float = 0.6
    min_score: float = 0.6
    min_length: int = 4


# The last two words ahead of a token; a word starts behind white space or at the start.
_AHEAD = r"(?<!\S)(?:(\S++)\s++)?(\S++)\s++$"


def _tokens(text: Column) -> Column:
    """Identifier tokens as ``array<struct<token, s, e, one, two>>``, in order.

    A token is trimmed of punctuation at its ends; ``one`` is the lower-case word
    ahead of it, if it holds a letter, ``two`` that word with the one ahead of it.
    """
    def one(x: Column) -> Column:
        lead = F.char_length(F.regexp_extract(x["m"], r"^([\p{Punct}&&[^+@]]*)", 1))
        bare = F.regexp_replace(F.regexp_replace(x["m"], r"^[\p{Punct}&&[^+@]]+", ""), r"(?<!\p{Punct})\p{Punct}++$", "")
        start = x["s"] + lead
        first, last = (F.lower(F.regexp_extract(x["b"], _AHEAD, i)) for i in (1, 2))
        last = F.when(last.rlike(r"\p{L}"), last)
        return F.struct(bare.alias("token"), start.alias("s"), (start + F.char_length(bare)).alias("e"), last.alias("one"),
                        F.when(first != "", F.concat(first, F.lit(" "), last)).alias("two"),
                        x["s"].alias("from"), x["e"].alias("to"))
    return F.transform(match_spans(text, _TOKEN, with_before=True), one)


_INDEX = 1 << 31                 # an end and an index share a long


def _with_seeds(tokens: Column, seeds: Column) -> Column:
    """``array<struct<token, s, e, one, two, seed>>``: a token that touches a base span is a seed and stands for that entity.

    Both lists run by their starts, so one merge by start places them: what may
    touch a token is the seed that reaches furthest of those that start before it
    (a running maximum) and the first one that starts later.
    """
    def merged(v: Column) -> Column:
        events = F.array_sort(F.concat(
            F.transform(v["seeds"], lambda x, i: F.struct(x["s"].alias("at"), F.lit(0).alias("k"),
                                                          (x["e"] * _INDEX + i).alias("reach"), i.cast("int").alias("i"))),
            F.transform(v["tokens"], lambda x, i: F.struct(x["from"].alias("at"), F.lit(1).alias("k"),
                                                           F.lit(0).cast("long").alias("reach"), i.cast("int").alias("i")))))

        def placed(ev: Column) -> Column:
            def joined(w: Column) -> Column:
                def of(x: Column, n: Column) -> Column:
                    token = v["tokens"][x["i"]]
                    before, after = w["reach"][n], F.get(v["seeds"], n - x["i"])       # n - i seeds start before the token
                    entity = F.when(F.floor(before / _INDEX) > token["from"], F.get(v["seeds"], (before % _INDEX).cast("int"))["m"]) \
                        .when(after["s"] < token["to"], after["m"])
                    return F.when(x["k"] == 1, F.struct(
                        F.coalesce(entity, token["token"]).alias("token"), token["s"].alias("s"), token["e"].alias("e"),
                        token["one"].alias("one"), token["two"].alias("two"), entity.isNotNull().alias("seed")))
                return F.filter(F.transform(w["ev"], of), lambda x: x.isNotNull())
            return let(F.struct(ev.alias("ev"), prefix_max(F.transform(ev, lambda x: x["reach"])).alias("reach")), joined)
        return let(events, placed)
    return let(F.struct(tokens.alias("tokens"), F.array_sort(seeds).alias("seeds")), merged)


def survey(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row without its text: ``id, h`` (hash of the text), base spans and identifier tokens.

    Written to shared storage, so texts are matched once.
    """
    t = named(text_col).cast("string")
    rows = docs.select(named(id_col).cast("long").alias("id"), F.xxhash64(t).alias("h"), t.alias("t"),
                       *[base_spans(_text(t), k).alias(k) for k in BASE_KINDS])
    seeds = F.flatten(F.array(*[F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))
                                for k in BASE_KINDS]))
    tokens = F.when(F.col("t").rlike("[0-9@]"), _with_seeds(_tokens(F.col("t")), seeds))
    slim = [F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in BASE_KINDS]
    path = scratch_path(docs.sparkSession, "pii-survey")
    rows.select("id", "h", *slim, tokens.alias("tokens")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def score_graph(spark: SparkSession, found: DataFrame, occurring: DataFrame, b: Bootstrap) -> tuple[DataFrame, DataFrame]:
    """Confident patterns ``before, confidence`` and the instances they introduce, ``token, score``.

    ``found`` holds the pattern-instance edges (with repeats), ``occurring`` a row
    ``before`` for every place where a pattern's words stand at all.  A pattern's
    confidence is the summed score of its distinct instances' occurrences over all
    occurrences of its words; an instance's score is 1 for a seed, else the
    noisy-or of the confidences of its patterns.  Every round is two partial
    aggregations on the edge table, written to shared storage.
    """
    edges = found.where("before IS NOT NULL").groupBy("before", "token").agg(
        F.count("*").alias("n"), F.max(F.col("seed").cast("int")).alias("is_seed"))
    path = scratch_path(spark, "pii-edges")
    edges.write.parquet(path)
    edges = spark.read.parquet(path)
    seeded = edges.where("is_seed = 1").groupBy("before").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= b.min_seeds)
    path = scratch_path(spark, "pii-seeded")
    seeded.select("before").write.parquet(path)
    totals = occurring.join(spark.read.parquet(path), "before").groupBy("before").agg(F.count("*").alias("total"))
    path = scratch_path(spark, "pii-totals")
    totals.write.parquet(path)
    totals = spark.read.parquet(path)
    edges = edges.join(totals.select("before"), "before")          # other patterns can never score
    score = None
    patterns = None
    for _ in range(b.rounds):
        weighted = edges if score is None else edges.join(score, "token", "left")
        value = F.when(F.col("is_seed") == 1, 1.0).otherwise(0.0 if score is None else F.coalesce("score", F.lit(0.0)))
        patterns = (weighted.groupBy("before").agg(F.sum(F.col("n") * value).alias("good")).join(totals, "before")
                    .select("before", F.least(F.lit(1.0), F.col("good") / F.col("total")).alias("confidence")))
        path = scratch_path(spark, "pii-patterns")
        patterns.where(F.col("confidence") >= b.min_confidence).write.parquet(path)
        patterns = spark.read.parquet(path)
        score = edges.where("is_seed = 0").join(patterns, "before").groupBy("token").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))).alias("score"))
    return patterns, score


def context_spans(docs: DataFrame, surveyed: DataFrame, b: Bootstrap = Bootstrap(), text_col: str = "text") -> DataFrame:
    """``id, h, context``: the spans that confident patterns add, per distinct (id, text hash), sorted by start."""
    spark = docs.sparkSession
    found = surveyed.where("tokens IS NOT NULL").select("id", "h", F.explode("tokens").alias("x")).select(
        "id", "h", "x.token", "x.s", "x.e", "x.seed", F.explode(F.array("x.one", "x.two")).alias("before"))
    # where words and pairs of words stand at all, in the texts that hold identifiers
    words = F.split(F.lower("t"), r"\s+")
    pairs = F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.concat(F.col("w")[i], F.lit(" "), F.col("w")[i + 1]))
    occurring = (docs.select(named(text_col).cast("string").alias("t")).where(F.col("t").rlike("[0-9@]"))
                 .select(words.alias("w")).select(F.explode(F.when(F.size("w") > 1, F.concat("w", pairs)).otherwise(F.col("w"))).alias("before")))
    patterns, score = score_graph(spark, found, occurring, b)
    new = (found.where(~F.col("seed") & (F.char_length("token") >= b.min_length)).join(patterns.select("before"), "before")
           .join(score.where(F.col("score") >= b.min_score), "token"))
    path = scratch_path(spark, "pii-context")
    new.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("context")).write.parquet(path)
    return spark.read.parquet(path)


def _joined(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def find_pii(docs: DataFrame, bootstrap: Bootstrap = Bootstrap(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Personal data of every whole text, one row per input row.

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context``;
    spans are ``kind:start:end`` in code points (end exclusive) by kind, then
    start; ``base_sha256`` is the digest of the base ones alone.  Null or empty
    text has no spans; ids may be null or repeat; other columns are not read; an
    empty table gives an empty result.
    """
    own = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    rows = survey(own)
    more = context_spans(own, rows, bootstrap)
    rows = rows.drop("tokens").alias("l").join(
        more.alias("r"), F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.h") == F.col("r.h")), "left")
    listed = [_joined(k, F.col("l." + k)) for k in BASE_KINDS]
    context = F.coalesce(_joined("context", F.col("r.context")), F.array().cast("array<string>"))
    return rows.select(
        F.col("l.id").alias("doc_id"), *[F.size("l." + k).cast("long").alias("n_" + k) for k in BASE_KINDS],
        F.sha2(F.concat_ws(",", F.flatten(F.array(*listed))), 256).alias("base_sha256"),
        F.concat_ws(",", F.flatten(F.array(*listed, context))).alias("spans"), F.size(context).cast("long").alias("n_context"))


_PIECE = 4096                   # characters of the pieces that a text is cut from


def redact(docs: DataFrame, bootstrap: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with every span replaced by ``<KIND>``; other columns as they are, null text stays null.

    Overlapping spans are replaced once, by the kind that starts first (listed
    order on ties) and up to the furthest end.
    """
    new = fresh_names(docs.columns, "id", "h", "context")
    t = named(text_col).cast("string")
    more = context_spans(docs, survey(docs, id_col, text_col), bootstrap, text_col).select(
        F.col("id").alias(new["id"]), F.col("h").alias(new["h"]), F.col("context").alias(new["context"]))
    based = docs.join(more, named(id_col).cast("long").eqNullSafe(F.col(new["id"])) & (F.xxhash64(t) == F.col(new["h"])), "left")
    kinds = [base_spans(_text(t), k) for k in BASE_KINDS] + [
        F.coalesce(F.col(new["context"]), F.array().cast("array<struct<s:bigint,e:bigint>>"))]

    def of_kind(i: int, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))
    tagged = F.array_sort(F.flatten(F.array(*[of_kind(i, spans) for i, spans in enumerate(kinds)])))
    text = F.when(t.rlike("[0-9@]"), let(tagged, lambda spans: F.when(F.size(spans) > 0, _replaced(t, spans)).otherwise(t))).otherwise(t)
    return based.select(*[text.alias(c) if c == text_col else named(c) for c in docs.columns])


def _replaced(t: Column, spans: Column) -> Column:
    """The text with the sorted spans ``s, k, e`` replaced by their kinds' names, overlapping ones as one."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.char_length(t) / _PIECE).cast("int")),
                         lambda b: F.substring(t, b * _PIECE + 1, F.lit(_PIECE)))

    def between(p: Column, a: Column, b: Column) -> Column:
        """Characters a to b: a substring of the few pieces that hold them."""
        first = F.floor(a / _PIECE).cast("int")
        held = F.array_join(F.slice(p, first + 1, F.floor(b / _PIECE).cast("int") - first + 1), "")
        return F.substring(held, (a - first * _PIECE + 1).cast("int"), (b - a).cast("int"))

    def regions(v: Column) -> Column:
        # a span that starts before the furthest end so far belongs to the region before it
        opens = F.filter(F.transform(v["spans"], lambda x, i: F.struct(
            x["s"].alias("s"), x["k"].alias("k"), i.cast("int").alias("i"),
            ((i == 0) | (x["s"] >= F.get(v["reach"], i - 1))).alias("new"))), lambda x: x["new"])
        return let(opens, lambda o: F.transform(o, lambda x, j: F.struct(
            x["s"].alias("s"), x["k"].alias("k"),
            F.get(v["reach"], F.coalesce(F.get(o, j + 1)["i"], F.size(v["spans"])) - 1).alias("e"))))

    def cut(v: Column) -> Column:
        zero = F.lit(0).cast("long")
        parts = F.transform(v["r"], lambda x, j: F.concat(
            between(v["p"], F.coalesce(F.get(v["r"], j - 1)["e"], zero), x["s"]), names[x["k"]]))
        return F.concat(F.array_join(parts, ""), between(v["p"], F.element_at(v["r"], -1)["e"], F.char_length(t).cast("long")))
    reach = prefix_max(F.transform(spans, lambda x: x["e"]))
    return let(let(F.struct(spans.alias("spans"), reach.alias("reach")), regions),
               lambda r: let(F.struct(r.alias("r"), pieces.alias("p")), cut))
