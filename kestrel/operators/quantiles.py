"""Exact interpolated quantiles per group for low-cardinality measures (counts, ratings).

Rows are first reduced to ``(group, value, count)`` with partial aggregation,
so no task holds a group's rows; the cumulative window then runs over distinct
values only.  (``percentile`` would buffer every value of a group in memory.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """``group..., n, min, max, <name>...`` with linear interpolation (``quantile_cont``)."""
    group = list(group)
    h = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*group).orderBy(value)
    h = (h.withColumn("_hi", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
         .withColumn("_lo", F.col("_hi") - F.col("_c") + 1))
    n = h.groupBy(*group).agg(F.sum("_c").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"))
    t = h.join(n.select(*group, "n"), group)

    def at(rank):   # the value whose cumulative-count range holds ``rank``
        return F.max(F.when((F.col("_lo") <= rank) & (F.col("_hi") >= rank), F.col(value)))

    aggs, outs = [], []
    for name, p in probs.items():
        pos = (F.col("n") - 1) * p
        aggs += [at(F.floor(pos)).alias(f"_{name}_0"), at(F.ceil(pos)).alias(f"_{name}_1"),
                 F.first(pos - F.floor(pos)).alias(f"_{name}_f")]
        lo, hi, frac = F.col(f"_{name}_0"), F.col(f"_{name}_1"), F.col(f"_{name}_f")
        outs.append((lo + (hi - lo) * frac).alias(name))
    q = t.groupBy(*group).agg(*aggs).select(*group, *outs)
    return n.join(q, group)
