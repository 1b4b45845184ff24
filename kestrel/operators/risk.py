"""Sliding top-decile cutoffs and the risk flags they raise (batch form).

Event-time statement of the original micro-batch job: time is cut into
``slide`` slots; the window ending at slot ``e`` holds slots ``e-w+1 .. e``;
its threshold is the k-th largest cost in it with ``k = floor(n/10)`` (NULL when
``k = 0``).  A row in slot ``s`` is flagged when its cost is strictly above the
last non-NULL threshold of a window ending before ``s``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.bins import log_bin
from kestrel.operators.topk import value_at_rank

# Category labels of the two flags (fixed by the original index documents).
HOUSING = "Top Centile Housing Costs"
CHILDCARE = "Top Centile Childcare Costs"


def long_costs(customers: DataFrame) -> DataFrame:
    """One row per (record, category): ``tstamp, nino, risk_category, cost`` (one scan, unpivot)."""
    pairs = F.array(F.struct(F.lit(HOUSING).alias("risk_category"), F.col("housing").cast("double").alias("cost")),
                    F.struct(F.lit(CHILDCARE).alias("risk_category"), F.col("childcare").cast("double").alias("cost")))
    return customers.select("tstamp", "nino", F.inline(pairs))


def slot_of(ts: str, slide_seconds: int) -> Column:
    return F.floor(F.unix_timestamp(F.col(ts)) / slide_seconds).cast("long")


def window_thresholds(costs: DataFrame, slide_seconds: int, w: int, lo=None, hi=None) -> DataFrame:
    """``risk_category, end_slot, n, k, kth`` for every window holding data (``k = floor(n/10)``).

    Every slot has a mergeable histogram of its costs (:mod:`kestrel.operators.bins`),
    combined before the shuffle.  A window merges the histograms of its ``w``
    slots, which gives its size and the bin of its rank ``k``, and costs its slots
    and not its values.  Then the values of that bin alone, with counts per slot,
    are summed per window and ranked exactly.  ``lo``/``hi`` restrict the windows.
    """
    s = costs.select("risk_category", F.col("cost"), slot_of("tstamp", slide_seconds).alias("slot"))
    return slot_thresholds(s, w, lo, hi)


def slot_thresholds(s: DataFrame, w: int, lo=None, hi=None) -> DataFrame:
    """:func:`window_thresholds` of rows ``risk_category, cost, slot``."""
    cat, win = ["risk_category"], ["risk_category", "end_slot"]
    valued = s.groupBy(*cat, "slot", "cost").agg(F.count("*").alias("_rows")).withColumn("_bin", F.coalesce(log_bin("cost"), F.lit(0)))
    slots = valued.groupBy(*cat, "slot", "_bin").agg(F.sum(F.when(F.col("cost").isNotNull(), F.col("_rows"))).alias("_n"))
    ends = F.explode(F.sequence("slot", F.col("slot") + (w - 1))).alias("end_slot")
    per_bin = slots.select(*cat, "_bin", F.coalesce("_n", F.lit(0)).alias("_n"), ends)
    if lo is not None:
        per_bin = per_bin.where(F.col("end_slot").between(lo, hi))
    per_bin = per_bin.groupBy(*win, "_bin").agg(F.sum("_n").alias("_n"))
    desc = Window.partitionBy(*win).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0)
    per_bin = (per_bin.withColumn("n", F.sum("_n").over(Window.partitionBy(*win)))
               .withColumn("_upto", F.sum("_n").over(desc)).withColumn("k", F.floor(F.col("n") / 10).cast("long")))
    windows = per_bin.groupBy(*win).agg(F.first("n").alias("n"), F.first("k").alias("k"))
    target = per_bin.where((F.col("_upto") >= F.col("k")) & (F.col("_upto") - F.col("_n") < F.col("k"))).select(
        *win, "_bin", (F.col("k") - F.col("_upto") + F.col("_n")).alias("_k"),
        F.explode(F.sequence(F.col("end_slot") - (w - 1), F.col("end_slot"))).alias("slot"))
    counted = (target.join(valued.where("cost IS NOT NULL"), cat + ["slot", "_bin"])
               .groupBy(*win, "_k", "cost").agg(F.sum("_rows").alias("_rows")))
    return windows.join(value_at_rank(counted, win, "cost", "_rows", "_k"), win, "left").select(*win, "n", "k", "kth")


def carried_cutoffs(thresholds: DataFrame, epoch_slots: int = 4096) -> DataFrame:
    """``cutoff(e)`` = last non-NULL threshold of a window ending strictly before ``e``.

    The carry runs per ``(category, epoch)`` of ``epoch_slots`` slots; the last
    non-NULL threshold of earlier epochs comes from a one-row-per-epoch table,
    so no task holds more than one epoch of window ends.
    """
    t = thresholds.withColumn("_epoch", F.floor(F.col("end_slot") / epoch_slots))
    w_in = (Window.partitionBy("risk_category", "_epoch").orderBy("end_slot")
            .rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("_in", F.last("kth", ignorenulls=True).over(w_in))
    per_epoch = t.groupBy("risk_category", "_epoch").agg(
        F.max_by("kth", F.when(F.col("kth").isNotNull(), F.col("end_slot"))).alias("_last"))
    w_ep = Window.partitionBy("risk_category").orderBy("_epoch").rowsBetween(Window.unboundedPreceding, -1)
    per_epoch = per_epoch.select("risk_category", "_epoch",
                                 F.last("_last", ignorenulls=True).over(w_ep).alias("_carry"))
    out = t.join(per_epoch, ["risk_category", "_epoch"])
    return out.select("risk_category", "end_slot", F.coalesce("_in", "_carry").alias("cutoff"))


def flag(costs: DataFrame, cutoffs: DataFrame, slide_seconds: int) -> DataFrame:
    """Rows strictly above the cutoff known before their slot (no cutoff yet → no row)."""
    s = costs.withColumn("slot", slot_of("tstamp", slide_seconds))
    j = s.join(cutoffs, (s["risk_category"] == cutoffs["risk_category"]) & (s["slot"] == cutoffs["end_slot"]))
    return j.where(F.col("cost") > F.col("cutoff")).select("tstamp", "nino", s["risk_category"], "cost")


def risk_flags(customers: DataFrame, slide_seconds: int, w: int) -> DataFrame:
    costs = long_costs(customers)
    return flag(costs, carried_cutoffs(window_thresholds(costs, slide_seconds, w)), slide_seconds)
