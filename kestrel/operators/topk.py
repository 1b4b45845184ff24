"""Top-k per group and exact k-th largest value, both skew-tolerant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.bins import coarse_bin, fine_bin


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_name: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group under ``order`` (a total order), ranked 1..k.

    Spark cuts every map task to ``k`` rows per group before the shuffle, so a
    hot group never meets whole in one task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)


def value_at_rank(counted: DataFrame, group: Sequence[str], value: str, count: str, k: str = "k") -> DataFrame:
    """``group..., kth``: the ``k``-th largest of values given with their counts (one row per distinct value)."""
    group = list(group)
    w = Window.partitionBy(*group).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum(count).over(w))
    hit = (F.col("_upto") >= F.col(k)) & (F.col("_upto") - F.col(count) < F.col(k))
    return upto.where(hit).select(*group, F.col(value).alias("kth"))


def kth_largest(df: DataFrame, group: Sequence[str], value: str, k: Column | None = None) -> DataFrame:
    """Exact k-th largest ``value`` per group (duplicates count), ``k = floor(n/10)`` by default.

    Returns ``group..., n, k, kth`` with ``kth`` NULL when ``k`` is 0 or exceeds ``n``.

    Rows are reduced to distinct values with counts (combined before the
    shuffle).  Counts per bin of the value (:mod:`kestrel.operators.bins`) give
    the bin that holds rank ``k``, counts per fine bin inside it the fine bin, and
    a running count over that fine bin's values the value: no task sees more of a
    group than its bins and one fine bin.
    """
    group = list(group)
    fine = fine_bin(value)
    cand = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n")).withColumn("_fine", fine)
    stats = df.groupBy(*group).agg(F.count(value).alias("n"))
    kcol = k if k is not None else F.floor(F.col("n") / 10)
    stats = stats.withColumn("k", kcol.cast("long"))
    want = stats.select(*group, "k")                               # rank sought among the candidates
    for bin_ in (coarse_bin("_fine"), F.col("_fine")):
        cand = cand.withColumn("_bin", bin_)
        counts = cand.groupBy(*group, "_bin").agg(F.sum("_n").alias("_c"))
        upto = F.sum("_c").over(Window.partitionBy(*group).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0))
        target = counts.withColumn("_above", upto - F.col("_c")).join(want, group).where(
            (F.col("k") > F.col("_above")) & (F.col("k") <= F.col("_above") + F.col("_c"))).select(
                *group, "_bin", (F.col("k") - F.col("_above")).alias("k"))
        cand = cand.join(target.select(*group, "_bin"), group + ["_bin"]).select(*group, value, "_n", "_fine")
        want = target.select(*group, "k")
    counted = cand.join(want, group)
    return stats.join(value_at_rank(counted, group, value, "_n"), group, "left").select(*group, "n", "k", "kth")
