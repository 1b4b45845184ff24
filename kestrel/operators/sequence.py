"""Successor-row values within an ordered key, spread over time buckets.

``lead() over (partition by key order by ...)`` puts a whole key in one task;
a vehicle that sends a third of all pings would make that task a third of the
job.  Here the window runs per ``(key, bucket)`` (e.g. per vehicle-hour), so a
hot key spreads over as many tasks as it has buckets.  The last row of each
bucket takes its successor from the first row of the key's next non-empty
bucket; those first rows form a small table (one row per key-bucket) whose own
window is cheap.  The result equals the plain per-key ``lead``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def next_in_sequence(df: DataFrame, key: str, bucket: str, order: Sequence[str],
                     carry: Sequence[str], suffix: str = "_next") -> DataFrame:
    """Add ``<c><suffix>`` = value of ``c`` in the next row of the same ``key``.

    ``bucket`` must be non-decreasing along ``order`` within a key (e.g. the
    hour of the ordering timestamp).  Rows without a successor get NULLs.
    When ``df`` is already hash-partitioned on ``(key, bucket)`` the window,
    the bucket-first aggregate and the join all reuse that one shuffle.
    """
    order_cols = [F.col(c) for c in order]
    w = Window.partitionBy(key, bucket).orderBy(*order_cols)
    staged = df
    for c in carry:
        staged = staged.withColumn(f"_in_{c}", F.lead(c).over(w))
    staged = staged.withColumn("_has_next", F.lead(F.lit(True)).over(w))

    # First row of every (key, bucket): partial aggregate, no extra shuffle.
    firsts = df.groupBy(key, bucket).agg(F.min_by(F.struct(*carry), F.struct(*order)).alias("_first"))
    # Successor bucket per key: one row per key-bucket, a small window.
    wb = Window.partitionBy(key).orderBy(bucket)
    succ = firsts.select(key, bucket, F.lead("_first").over(wb).alias("_succ"))

    out = staged.join(succ, [key, bucket], "left")
    for c in carry:
        out = out.withColumn(
            f"{c}{suffix}",
            F.when(F.col("_has_next").isNotNull(), F.col(f"_in_{c}")).otherwise(F.col(f"_succ.{c}")))
    return out.drop("_has_next", "_succ", *[f"_in_{c}" for c in carry])


def previous_in_sequence(df: DataFrame, key: str, bucket: str, order: Sequence[str], col: str, name: str) -> DataFrame:
    """Add ``name`` = value of ``col`` in the previous row of the same ``key``; NULL for the first.

    ``bucket`` as in :func:`next_in_sequence`: the window runs per ``(key,
    bucket)``, and a bucket's first row takes the last value of the key's
    previous bucket from a table of one row per bucket.
    """
    w = Window.partitionBy(key, bucket).orderBy(*[F.col(c) for c in order])
    lasts = df.groupBy(key, bucket).agg(F.max_by(F.struct(col), F.struct(*order)).alias("_last"))
    wb = Window.partitionBy(key).orderBy(bucket)
    before = lasts.select(key, bucket, F.lag("_last").over(wb).alias("_before"))
    staged = df.withColumn("_first", F.row_number().over(w) == 1).withColumn("_in", F.lag(col).over(w))
    return (staged.join(before, [key, bucket], "left")
            .withColumn(name, F.when(F.col("_first"), F.col(f"_before.{col}")).otherwise(F.col("_in")))
            .drop("_first", "_in", "_before"))


def row_index(df: DataFrame, key: str, order: Sequence[str], bucket: str, name: str = "index") -> DataFrame:
    """0-based position of each row within its key (a per-key ``zipWithIndex``).

    ``bucket`` as in :func:`next_in_sequence`: rows are numbered per ``(key,
    bucket)`` and shifted by the rows in the key's earlier buckets, so a hot key
    spreads over its buckets.
    """
    w = Window.partitionBy(key, bucket).orderBy(*[F.col(c) for c in order])
    wb = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(key, bucket).agg(F.count("*").alias("_n"))
    shifts = sizes.select(key, bucket, F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_shift"))
    return (df.withColumn("_in", F.row_number().over(w) - 1).join(shifts, [key, bucket])
            .withColumn(name, F.col("_in") + F.col("_shift")).drop("_in", "_shift"))
