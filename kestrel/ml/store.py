"""Versions of a model that a stream refits: one per micro-batch, swapped in by a commit record.

Layout under ``root`` (shared storage): every fit is saved to a folder of its
own under ``models/``, then a one-row record under ``versions/version=<batch>``
names that folder.  Readers follow the records only.  A batch that is replayed
after a failure writes a new folder and replaces its record, so nobody ever
sees a half-written model, and a version is replaced as a whole or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import path_exists

_RECORD = "version int, folder string, rows long"


class ModelStore:
    """Committed versions of one model; ``loader`` is the model class's ``load``."""

    def __init__(self, spark: SparkSession, root: str, loader: Callable):
        self.spark, self.root, self.loader = spark, root.rstrip("/"), loader

    def versions(self) -> DataFrame:
        """``version, folder, rows``: one row per committed version (``rows`` it was fitted on)."""
        if not path_exists(self.spark, f"{self.root}/versions"):
            return self.spark.createDataFrame([], _RECORD)
        return self.spark.read.schema(_RECORD).parquet(f"{self.root}/versions").select("version", "folder", "rows")

    def latest(self, before: int | None = None) -> int | None:
        """The newest committed version, or the newest below ``before``."""
        v = self.versions()
        if before is not None:
            v = v.where(F.col("version") < before)
        return v.agg(F.max("version")).first()[0]

    def save(self, model, version: int, rows: int) -> None:
        """Save and commit a version; an existing version of that number is replaced."""
        folder = f"{self.root}/models/{version:09d}-{uuid.uuid4().hex[:8]}"
        model.save(folder)
        record = self.spark.createDataFrame([(folder, rows)], "folder string, rows long")
        record.write.mode("overwrite").parquet(f"{self.root}/versions/version={version}")

    def load(self, version: int):
        """The model of a committed version."""
        row = self.versions().where(F.col("version") == version).first()
        if row is None:
            raise KeyError(f"version {version} was never committed")
        return self.loader(row["folder"])

    def expire(self, keep: int) -> list[int]:
        """Forget all but the newest ``keep`` versions, and every folder that no record names; returns the forgotten ones.

        Only for moments without a running fit: a fit under way has no record yet.
        """
        kept = {r["version"]: r["folder"] for r in self.versions().orderBy(F.desc("version")).limit(keep).collect()}
        gone = [r["version"] for r in self.versions().collect() if r["version"] not in kept]
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        named = {f.rstrip("/").rsplit("/", 1)[-1] for f in kept.values()}
        top = jvm.org.apache.hadoop.fs.Path(f"{self.root}/models")
        fs = top.getFileSystem(conf)
        for v in gone:                                             # the record first: a reader finds the model or no version
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/version={v}"), True)
        if fs.exists(top):
            for s in fs.listStatus(top):
                if s.getPath().getName() not in named:
                    fs.delete(s.getPath(), True)
        return sorted(gone)
