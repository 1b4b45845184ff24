"""Operators over one global order: rows are dealt to tasks by range, so no task holds a whole table or group.

The sorted rows are written once to shared storage with the number of their
range and their place in it.  One number per (group, range) then says how many
rows come before it.  A range is about a partition in size, however the rows
fall on groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import scratch_path

_PLACE_BITS = 33                 # monotonically_increasing_id keeps the place in the partition in these bits


def range_sorted(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``order`` with ``_range`` (ascending along the order) and ``_place`` (from 0 in the range)."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    path = scratch_path(spark, "range-sorted")
    dealt.write.parquet(path)                                      # the numbers are fixed from here on
    place = F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)
    return (spark.read.parquet(path).withColumn("_range", F.shiftright("_id", _PLACE_BITS).cast("int"))
            .withColumn("_place", place).drop("_id"))


def global_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """0-based position of every row in the whole table sorted by ``order`` (a distributed ``zipWithIndex``).

    ``order`` should be total: rows equal in all of it get consecutive numbers in
    any order.  Nulls come first, as in an ascending sort.
    """
    rows = range_sorted(df, order)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)    # one row per range
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # as many rows as the sort had partitions
    return (rows.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_before") + F.col("_place")).drop("_range", "_place", "_before"))


def range_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """``group..., n, min, max, <name>...`` with linear interpolation, for values with any number of distinct values.

    Rows are reduced to distinct values with counts and range-partitioned by
    ``(group, value)``; counts per (group, range) are summed along the ranges, and
    only the ranges that hold a wanted rank are opened, each apart.  Null values
    are left out; null groups are groups.
    """
    group = list(group)
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    rows = range_sorted(counted, [*group, value])
    same = [(g, f"_g{i}") for i, g in enumerate(group)]

    def keyed(frame):                                              # joins take null groups as equal
        return frame.select(*[F.col(g).alias(k) for g, k in same], *[c for c in frame.columns if c not in group])

    def on(left, right, more=()):
        return [left[g].eqNullSafe(right[k]) for g, k in same] + [left[c] == right[c] for c in more]
    per_range = rows.groupBy(*group, "_range").agg(F.sum("_c").alias("_c"), F.min(value).alias("_min"), F.max(value).alias("_max"))
    upto = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = per_range.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    path = scratch_path(df.sparkSession, "range-counts")
    per_range.write.parquet(path)
    per_range = df.sparkSession.read.parquet(path)
    stats = per_range.groupBy(*group).agg(F.sum("_c").alias("n"), F.min("_min").alias("min"), F.max("_max").alias("max"))
    # the two ranks around each quantile
    position = {name: (F.col("n") - 1) * p for name, p in probs.items()}
    wanted = stats.select(*group, F.explode(F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(x).cast("long"), F.ceil(x).cast("long")) for x in position.values()])))).alias("_rank"))
    wk = keyed(wanted)
    held = per_range.join(wk, [*on(per_range, wk), (wk["_rank"] >= per_range["_before"])
                               & (wk["_rank"] < per_range["_before"] + per_range["_c"])]).select(
        *group, "_range", "_before", "_rank")
    opened = keyed(held.select(*group, "_range", "_before").distinct())
    inside = rows.join(opened, on(rows, opened, ["_range"])).select(*group, rows["_range"], "_before", value, "_c")
    run = Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("_hi", F.col("_before") + F.sum("_c").over(run)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    hk = keyed(held.select(*group, "_range", "_rank"))
    found = inside.join(hk, [*on(inside, hk, ["_range"]), (hk["_rank"] >= inside["_lo"]) & (hk["_rank"] < inside["_hi"])])
    ranks = found.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("_rank", value))).alias("_at"))
    rk = keyed(ranks)
    out = stats.join(rk, on(stats, rk))
    for name, x in position.items():
        low, high = (F.element_at("_at", f(x).cast("long")) for f in (F.floor, F.ceil))
        out = out.withColumn(name, low + (high - low) * (x - F.floor(x)))
    return out.select(*group, "n", "min", "max", *probs)
