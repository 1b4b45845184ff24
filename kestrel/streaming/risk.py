"""Risk flags as a Structured Streaming job (foreachBatch with shared-storage state).

State lives in ``batch_id`` partitions under ``root`` (every write overwrites
only its own batch, so a batch replayed after a failure leaves the same
state).  For micro-batch ``N`` with slots ``lo..hi``:

1. rows behind ``max_seen - lateness`` go to ``late/`` and are counted in
   ``meta/``; the rest are stored under ``values/``, by epoch of slots;
2. ``boundary = min(lo, max_seen - lateness) - w``: windows ending before it
   can no longer change.  Thresholds of windows ``boundary .. hi+w-1`` are
   recomputed from stored values of slots ``boundary-w+1 .. hi``; only the
   epochs that hold those slots are listed and read;
3. the last non-NULL threshold of a window ending before ``boundary`` (the
   *carry*) comes from the previous batch's carry and thresholds — one row
   per category — so a batch never reads the whole history;
4. cutoffs for ``lo..hi`` = last non-NULL over carry + recomputed thresholds;
   rows strictly above are flagged into ``flags/``.

Every batch, empty ones too, writes ``meta/`` with the newest slot seen and the
last batch that held data, so a batch finds its predecessor at ``N - 1`` without
listing.  Only a missing path means "nothing yet"; storage errors are raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.risk import carried_cutoffs, flag, long_costs, slot_of, slot_thresholds
from kestrel.session import path_exists
from kestrel.streaming.runner import run_available_now

EPOCH_SLOTS = 4096


def _previous(spark: SparkSession, meta: str, batch_id: int):
    """(newest slot seen, last batch with data) before this batch; (None, None) at the start."""
    path = f"{meta}/batch_id={batch_id - 1}"
    if batch_id == 0 or not path_exists(spark, path):
        return None, None
    row = spark.read.parquet(path).first()
    return row["max_seen"], row["data_batch"]


def risk_flag_batch_fn(spark: SparkSession, root: str, slide_seconds: int, w: int, lateness_slots: int = 0,
                       flag_sink=None):
    """``foreachBatch`` body; ``flag_sink(flags, batch_id)`` is called with each batch's flags, if given.

    ``lateness_slots``: how many slots behind the newest one a row may come.
    Rows further behind are kept in ``late/`` and are not flagged.
    """
    values, thresholds, carry, meta, flags, late = (
        f"{root}/{d}" for d in ("values", "thresholds", "carry", "meta", "flags", "late"))

    def put_meta(batch_id: int, max_seen, data_batch, n_late: int) -> None:
        spark.createDataFrame([(max_seen, data_batch, n_late)], "max_seen long, data_batch long, late_rows long") \
            .write.mode("overwrite").parquet(f"{meta}/batch_id={batch_id}")

    def fn(batch: DataFrame, batch_id: int) -> None:
        seen, prev = _previous(spark, meta, batch_id)
        costs = long_costs(batch).withColumn("slot", slot_of("tstamp", slide_seconds))
        n_late = 0
        if seen is not None:
            behind = F.col("slot") < seen - lateness_slots
            costs.where(behind).write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
            n_late = spark.read.parquet(f"{late}/batch_id={batch_id}").count()
            costs = costs.where(~behind)
        lo, hi = costs.select(F.min("slot"), F.max("slot")).first()
        if lo is None:
            put_meta(batch_id, seen, prev, n_late)
            return
        max_seen = hi if seen is None else max(seen, hi)
        boundary = min(lo, max_seen - lateness_slots) - w
        for epoch in range(lo // EPOCH_SLOTS, hi // EPOCH_SLOTS + 1):
            (costs.where(F.floor(F.col("slot") / EPOCH_SLOTS) == epoch)
             .write.mode("overwrite").parquet(f"{values}/epoch={epoch}/batch_id={batch_id}"))

        epochs = [p for e in range((boundary - w + 1) // EPOCH_SLOTS, hi // EPOCH_SLOTS + 1)
                  if path_exists(spark, p := f"{values}/epoch={e}")]
        recent = (spark.read.option("basePath", values).parquet(*epochs)
                  .where((F.col("batch_id") <= batch_id) & F.col("slot").between(boundary - w + 1, hi)))
        thr = slot_thresholds(recent.select("risk_category", "cost", "slot"), w, boundary, hi + w - 1)
        thr.select("risk_category", "end_slot", "kth").write.mode("overwrite").parquet(f"{thresholds}/batch_id={batch_id}")
        thr = spark.read.parquet(f"{thresholds}/batch_id={batch_id}")

        cand_schema = "risk_category string, end_slot long, kth double"
        cand = spark.createDataFrame([], cand_schema)
        if prev is not None:
            cand = cand.unionByName(spark.read.parquet(f"{carry}/batch_id={prev}").select(cand.columns)).unionByName(
                spark.read.parquet(f"{thresholds}/batch_id={prev}").select(cand.columns).where(F.col("end_slot") < boundary))
        new_carry = (cand.where(F.col("kth").isNotNull()).groupBy("risk_category")
                     .agg(F.max_by(F.struct("end_slot", "kth"), "end_slot").alias("c"))
                     .select("risk_category", "c.end_slot", "c.kth"))
        new_carry.write.mode("overwrite").parquet(f"{carry}/batch_id={batch_id}")
        new_carry = spark.read.parquet(f"{carry}/batch_id={batch_id}")

        cutoffs = carried_cutoffs(new_carry.unionByName(thr)).where(F.col("end_slot").between(lo, hi))
        flag(costs.drop("slot"), cutoffs, slide_seconds).write.mode("overwrite") \
            .parquet(f"{flags}/batch_id={batch_id}")
        if flag_sink is not None:
            flag_sink(spark.read.parquet(f"{flags}/batch_id={batch_id}"), batch_id)
        put_meta(batch_id, max_seen, batch_id, n_late)              # last: a batch without it is done again

    return fn


def run_risk_flags(spark: SparkSession, stream: DataFrame, root: str, checkpoint: str,
                   slide_seconds: int, w: int, lateness_slots: int = 0) -> DataFrame:
    """Run the flagging stream to completion; return every flag raised (late rows: ``root/late``)."""
    run_available_now(stream, risk_flag_batch_fn(spark, root, slide_seconds, w, lateness_slots), checkpoint)
    return spark.read.parquet(f"{root}/flags").drop("batch_id")


__all__ = ["run_risk_flags", "risk_flag_batch_fn"]
