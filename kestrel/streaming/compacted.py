"""Keyed state of a stream as a log of batches over compacted snapshots.

Every micro-batch writes its rows to a partition of its own under ``log/``.
Every few batches a snapshot takes in all finished batches: one merged row per
key, in a folder of its own under ``snapshots/``, which a one-row record under
``marks/`` names.  A read merges the newest snapshot with the few batches after
it, so it costs the keys and not the history.  Nothing is changed in place: a
batch that is replayed replaces its own partition, and only batches that can no
longer be replayed are taken into a snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import path_exists
from kestrel.streaming.runner import computed_once


class CompactedLog:
    """``merge`` reduces rows to one per key (it must not matter in what order and how often); ``prune`` drops what a
    snapshot need not keep; ``every`` is the number of batches between snapshots."""

    def __init__(self, spark: SparkSession, root: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 every: int = 10, prune: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.root, self.merge, self.every, self.prune = spark, root.rstrip("/"), merge, every, prune
        self.schema = T.StructType.fromDDL(schema)
        self.columns = self.schema.names

    def mark(self) -> tuple[int, str | None]:
        """(last batch in the newest snapshot, its folder); (-1, None) before the first."""
        if not path_exists(self.spark, f"{self.root}/marks"):
            return -1, None
        newest = self.spark.read.schema("folder string, upto long").parquet(f"{self.root}/marks").orderBy(F.desc("upto")).first()
        return (newest["upto"], newest["folder"]) if newest else (-1, None)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch; when the last snapshot is ``every`` batches behind, the batches before this one make a new one."""
        rows.select(*self.columns).write.mode("overwrite").parquet(f"{self.root}/log/batch_id={batch_id}")
        upto, _ = self.mark()
        if batch_id - 1 - upto >= self.every:
            self.compact(batch_id - 1)

    def _log(self, after: int, upto: int | None) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/log"):
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        log = self.spark.read.schema(schema).parquet(f"{self.root}/log").where(F.col("batch_id") > after)
        return (log if upto is None else log.where(F.col("batch_id") <= upto)).select(*self.columns)

    def read(self, upto: int | None = None) -> DataFrame:
        """One merged row per key over all batches, or over those up to ``upto`` (not before the newest snapshot)."""
        after, folder = self.mark()
        if upto is not None and upto < after:
            raise ValueError(f"batches up to {after} are merged, {upto} cannot be read apart")
        rows = self._log(after, upto)
        if folder is not None:
            rows = self.spark.read.schema(self.schema).parquet(folder).unionByName(rows)
        return self.merge(rows).select(*self.columns)

    def compact(self, upto: int) -> None:
        """A new snapshot of all batches up to ``upto``, none of which may still be replayed.

        The batches and snapshots that the snapshot before it had replaced are
        removed, so readers that began with that one finish.
        """
        before, last = self.mark()
        if upto <= before:
            return
        rows = self.read(upto)
        folder = f"{self.root}/snapshots/{upto:012d}-{uuid.uuid4().hex[:8]}"
        (self.prune(rows) if self.prune else rows).select(*self.columns).write.parquet(folder)
        record = self.spark.createDataFrame([(folder,)], "folder string")
        record.write.mode("overwrite").parquet(f"{self.root}/marks/upto={upto}")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs = jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(conf)
        keep = {name.rsplit("/", 1)[-1] for name in (folder, last) if name}

        def drop(part: str, gone: Callable[[str], bool]) -> None:
            top = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}")
            for s in fs.listStatus(top) if fs.exists(top) else ():
                if gone(s.getPath().getName()):
                    fs.delete(s.getPath(), True)

        def number(name: str) -> int | None:
            return int(name.split("=")[1]) if "=" in name else None
        drop("marks", lambda n: (b := number(n)) is not None and b < before)
        drop("log", lambda n: (b := number(n)) is not None and b <= before)
        drop("snapshots", lambda n: n not in keep and int(n.split("-")[0]) < upto)


def changelog(spark: SparkSession, root: str, schema: str, keys: Sequence[str], every: int = 10) -> CompactedLog:
    """Log of an update-mode aggregate: the row of the newest batch per key; append through :func:`changelog_writer`."""
    values = [c for c in T.StructType.fromDDL(schema).names if c not in keys]

    def merge(rows: DataFrame) -> DataFrame:
        newest = [F.max_by(F.col(v), F.col("_batch")).alias(v) for v in values]
        return rows.groupBy(*keys).agg(*newest, F.max("_batch").alias("_batch"))
    return CompactedLog(spark, root, f"{schema}, _batch long", merge, every)


def changelog_writer(log: CompactedLog) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: append the batch's changed rows to the log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with computed_once(batch) as rows:
            if not rows.isEmpty():
                log.append(rows.withColumn("_batch", F.lit(batch_id).cast("long")), batch_id)
    return write
