"""Models that are refitted with every micro-batch of a stream.

Each batch is scored by the newest version committed before it, then joins the
training data, and the model fitted on the data so far becomes the batch's
version.  All three results are keyed by the batch id and replaced on replay:
a batch that runs again after a failure reads the same prefix of the data and
the same older version, so it scores and fits as it did before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.ml.store import ModelStore


def refreshed_model(store: ModelStore, history: str, fit: Callable[[DataFrame], object],
                    score: Callable[[object, DataFrame], DataFrame] | None = None, scores: str | None = None,
                    over: str = "history") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that scores a batch, keeps it in ``history`` and refits.

    ``fit(training rows)`` returns a model that can be saved, or None where the
    rows allow none yet; ``score(model, batch)`` returns the rows written to ``scores/batch_id=<id>`` with the
    ``version`` that scored them (nothing is scored before a first version).
    ``over``: ``"history"`` fits all batches so far, ``"batch"`` the batch alone.
    """
    if over not in ("history", "batch"):
        raise ValueError(f"over must be history or batch, not {over}")
    spark = store.spark

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch.write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
        # read back: later batches of an interrupted run may lie there already
        schema = T.StructType([*batch.schema.fields, T.StructField("batch_id", T.IntegerType())])
        every = spark.read.schema(schema).parquet(history)
        own = every.where(F.col("batch_id") == batch_id).drop("batch_id")
        used = store.latest(before=batch_id)
        if score is not None and used is not None:
            (score(store.load(used), own).withColumn("version", F.lit(used))
             .write.mode("overwrite").parquet(f"{scores}/batch_id={batch_id}"))
        rows = own if over == "batch" else every.where(F.col("batch_id") <= batch_id).drop("batch_id")
        if (model := fit(rows)) is not None:
            store.save(model, batch_id, rows.count())
    return step
