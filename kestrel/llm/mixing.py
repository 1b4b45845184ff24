"""Mixing sources to target weights by Poisson replication, in DataFrame expressions only.

A source's repetition rate is its share of the target size over its own size.
Every document is repeated a Poisson number of times with that mean: a uniform
number from a hash of the seed and the document's id is pushed through the
inverse distribution function.  The copies are then shuffled globally by a hash,
so neither order nor neighbours say where a copy came from.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.tables import fresh_names, named
from kestrel.session import scratch_path

SALTS = 32                      # ways a source's rows are dealt for the join with the rates
FEW_SOURCES = 10_000            # sources whose rates may be broadcast (about 4 MB)
OUTPUT = ("copy_no", "copies", "rate", "shuffle_key")
PIECE = 8.0                     # a larger rate is a sum of equal rates of at most this size


def hash_fraction(*parts: Column) -> Column:
    """A uniform number in (0, 1) from 52 bits of the MD5 of the joined parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, default_weight: float = 1.0,
                 epochs: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``source, n_docs, n_chars, weight, rate`` per source (a null source is one of its own).

    Weights need not add up to one; a source not named has ``default_weight``.
    The target size is ``epochs`` times the characters of the sources with text
    and a positive weight; rate = weight share * target / characters.  A source
    without a character cannot reach a share and gets rate 0, as does weight 0.
    Every row is counted, combined before the shuffle.
    """
    size = docs.groupBy(named(source_col).cast("string").alias("source")).agg(
        F.count("*").alias("n_docs"),
        F.sum(F.coalesce(F.char_length(named(text_col).cast("string")), F.lit(0)).cast("long")).alias("n_chars"))
    given = [F.lit(x) for name, w in sorted((weights or {}).items()) for x in (name, float(w))]
    weight = F.coalesce(F.create_map(*given)[F.col("source")], F.lit(float(default_weight))) if given else F.lit(
        float(default_weight))
    size = size.withColumn("weight", F.when(F.col("n_chars") > 0, weight).otherwise(0.0))
    total = size.where("weight > 0").agg(F.struct(F.sum("weight").alias("w"), F.sum("n_chars").alias("c"))).scalar()
    rate = F.when(F.col("weight") > 0, F.col("weight") / total["w"] * (F.lit(float(epochs)) * total["c"]) / F.col("n_chars"))
    return size.select("source", "n_docs", "n_chars", "weight", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """Distribution function values P(X <= 0), P(X <= 1), ... of a Poisson variable with mean up to PIECE.

    Forty terms: what lies beyond has less than 1e-15 of the probability.
    """
    first = F.exp(-rate)
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(40)),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("steps")),
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"), (acc["c"] + acc["p"] * rate / k).alias("c"),
            F.concat(acc["steps"], F.array(acc["c"] + acc["p"] * rate / k)).alias("steps")),
        lambda acc: acc["steps"])
    return terms


def _text_key(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, default_weight: float = 1.0, epochs: float = 1.0,
        seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Every document repeated by its Poisson count, globally shuffled.

    Output: all input columns, then ``copy_no`` (1, 2, ...), ``copies`` (the
    document's count), ``rate`` and ``shuffle_key`` (rows come sorted by it within
    hash-dealt partitions).  Those names replace input columns of the same name,
    upper or lower case; :func:`repeat_documents` returns the input columns alone,
    whatever their names.
    A document's count depends on seed and id only (repeated ids get the same
    count, a null id counts as the id ``null``), so it survives recomputation.
    The rates are one row per source, written to shared storage and counted: up
    to ``FEW_SOURCES`` are broadcast, so texts move once, in the shuffle; beyond,
    they are joined on (source, salt), which deals a source with a third of all
    rows over ``SALTS`` tasks.  Empty input gives an empty result.
    """
    counted, added, key = _counted(docs, weights, default_weight, epochs, seed, id_col, source_col, text_col)
    own = [named(c) for c in docs.columns if c.lower() not in OUTPUT]
    each = counted.select(*own, *[F.col(added[c]).alias(c) for c in OUTPUT[:3]], key.alias(OUTPUT[3]))
    return each.repartition(F.col(OUTPUT[3])).sortWithinPartitions(OUTPUT[3])


def repeat_documents(docs: DataFrame, weights: Mapping[str, float] | None = None, default_weight: float = 1.0,
                     epochs: float = 1.0, seed: int = 0, id_col: str = "doc_id", source_col: str = "source",
                     text_col: str = "text") -> DataFrame:
    """The same rows as :func:`mix`, with exactly the input's columns."""
    counted, added, key = _counted(docs, weights, default_weight, epochs, seed, id_col, source_col, text_col)
    each = counted.select(*map(named, docs.columns), key.alias(added["shuffle_key"]))
    each = each.repartition(F.col(added["shuffle_key"])).sortWithinPartitions(added["shuffle_key"])
    return each.select(*map(named, docs.columns))


def _counted(docs: DataFrame, weights, default_weight: float, epochs: float, seed: int, id_col: str, source_col: str,
             text_col: str) -> tuple[DataFrame, dict[str, str], Column]:
    """(documents exploded by their counts, names of the added columns, the order's key).

    The added columns get names that no input column has in upper or lower case.
    """
    added = fresh_names(docs.columns, "source", "draws", "steps", "salt", "salted", *OUTPUT)
    col = {name: F.col(fresh) for name, fresh in added.items()}
    every = [named(c) for c in docs.columns]
    rates = source_rates(docs, weights, default_weight, epochs, source_col, text_col)
    # a rate above PIECE is drawn as several smaller ones: sums of Poisson counts are Poisson
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE).cast("int"))
    rates = rates.select(F.col("source").alias(added["source"]), F.col("rate").alias(added["rate"]), draws.alias(added["draws"]))
    rates = rates.withColumn(added["steps"], poisson_steps(col["rate"] / col["draws"]))
    spark = docs.sparkSession
    path = scratch_path(spark, "mix-rates")
    rates.write.parquet(path)
    rates = spark.read.parquet(path)
    ident = _text_key(named(id_col))
    same = named(source_col).cast("string").eqNullSafe(col["source"])
    if rates.count() <= FEW_SOURCES:
        joined = docs.select(*every).join(F.broadcast(rates), same)
    else:                                                          # too many to broadcast: deal hot sources by a salt
        dealt = rates.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(added["salt"]))
        rows = docs.select(*every, F.pmod(F.xxhash64(ident), F.lit(SALTS)).cast("int").alias(added["salted"]))
        joined = rows.join(dealt, same & (col["salted"] == col["salt"]))
    drawn = F.transform(F.sequence(F.lit(1), col["draws"]), lambda i: hash_fraction(
        F.lit(f"count:{seed}"), i.cast("string"), ident))
    copies = F.aggregate(drawn, F.lit(0), lambda acc, u: acc + F.size(F.filter(col["steps"], lambda c: c <= u)))
    counted = joined.select(*every, col["rate"], copies.alias(added["copies"])).where(col["copies"] > 0)
    each = counted.select(*every, F.explode(F.sequence(F.lit(1), col["copies"])).alias(added["copy_no"]), col["copies"], col["rate"])
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"order:{seed}"), col["copy_no"].cast("string"), ident)),
                             1, 15), 16, 10).cast("long")
    return each, added, key
