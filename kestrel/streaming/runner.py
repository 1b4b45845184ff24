"""Stream sources, staged replay files, and update-mode changelog sinks.

Production sources are Kafka or a socket; tests and the registered queries
replay files staged from the driver tables (a file source with
``maxFilesPerTrigger`` gives deterministic micro-batches in file order; a
staged chunk's number of files makes it a micro-batch, so their number does not
grow with the tables).
Results are written by ``foreachBatch`` into ``batch_id`` partitions of a
table in shared storage, overwriting the batch's own partition, so a batch
replayed after a failure replaces its output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import count_files, scratch_path
from kestrel.streaming.lateness import LateGuard


def stream_source(spark: SparkSession, kind: str, **opts) -> DataFrame:
    """A streaming DataFrame with a string ``value`` column.

    ``kind``: ``kafka`` (``servers``, ``topic``; ``binary=True`` leaves payloads
    undecoded, e.g. for gzip), ``socket`` (``host``, ``port``) or ``files``
    (``path``; text lines).
    """
    if kind == "kafka":
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", opts["servers"])
                .option("subscribe", opts["topic"]).option("startingOffsets", opts.get("offsets", "earliest"))
                .load().selectExpr("value" if opts.get("binary") else "CAST(value AS STRING) AS value"))
    if kind == "socket":
        return (spark.readStream.format("socket").option("host", opts["host"])
                .option("port", int(opts["port"])).load())
    if kind == "files":
        return spark.readStream.option("maxFilesPerTrigger", opts.get("max_files", 1)).text(opts["path"])
    raise ValueError(f"unknown stream source {kind}")


class Staged(NamedTuple):
    """Chunk folders in order, how far ``order`` reaches within one chunk (seconds for times), and the most files that a
    chunk has: streamed by so many per micro-batch, the batches are no more than the chunks, however many tasks wrote them."""

    paths: list[str]
    span: int
    files: int

    def lateness(self, slack: int = 3600) -> str:
        """A watermark delay that no staged row can miss: files of one chunk come in any order."""
        return f"{self.span + slack} seconds"


def stage_files(df: DataFrame, path: str, order: str, n_files: int, fmt: str = "parquet",
                text_col: str | None = None) -> Staged:
    """Write ``df`` as ``n_files`` successive chunks of ``order`` (e.g. time), oldest first.

    Replaying them feeds the stream chunk by chunk; within a chunk there may be
    several files (one per task) in any order, hence :attr:`Staged.span`.  The
    source is read once.  (Fixture helper: a real deployment reads Kafka.)
    """
    df = df.persist()
    try:
        return _stage(df, path, order, n_files, fmt, text_col)
    finally:
        df.unpersist()


def _stage(df: DataFrame, path: str, order: str, n_files: int, fmt: str, text_col: str | None) -> Staged:
    key = F.unix_micros(F.col(order).cast("timestamp")) if dict(df.dtypes)[order].startswith("timestamp") \
        else F.col(order).cast("double")
    lo, hi = df.select(F.min(key), F.max(key)).first()
    span = (hi - lo) if hi is not None and hi > lo else 1
    chunk = F.least(F.floor((key - F.lit(lo)) * n_files / F.lit(span + 1)), F.lit(n_files - 1))
    tagged = df.withColumn("_chunk", chunk)
    paths = []
    for i in range(n_files):
        p = f"{path}/chunk={i:05d}"
        part = tagged.where(F.col("_chunk") == i).drop("_chunk")
        if fmt == "text":
            part.select(F.col(text_col).alias("value")).write.mode("overwrite").text(p)
        else:
            part.write.mode("overwrite").format(fmt).save(p)
        paths.append(p)
    per_second = 1_000_000 if dict(df.dtypes)[order].startswith("timestamp") else 1
    return Staged(paths, int((span + 1) / n_files / per_second) + 1, most_files(df.sparkSession, paths))


def most_files(spark: SparkSession, folders: Sequence[str]) -> int:
    """The largest number of data files in one of ``folders`` (1 at least)."""
    return max(1, *(count_files(spark, f"{p}/part-*") for p in folders))


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 1) -> DataFrame:
    """Replay staged files, ``max_files`` per micro-batch, in modification order."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", "true").format(fmt).load(path))


def run_available_now(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      mode: str = "append", name: str | None = None) -> None:
    """Process everything available now through ``fn`` (``foreachBatch``), then stop; dropped late rows are an error."""
    guard = LateGuard(stream.sparkSession)
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    if name:
        w = w.queryName(name)
    q = guard.watch(w.trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    guard.finish()


def start(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
          processing_time: str | None = None, name: str | None = None):
    """Start a long-running query (``processing_time`` e.g. ``"1 second"``); returns the handle.

    Without ``processing_time`` it processes what is available and stops.  Once
    an operator has dropped late rows, the next batch fails the query.
    """
    guard = LateGuard(stream.sparkSession)
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(guard.guarded(fn))
    if name:
        w = w.queryName(name)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return guard.watch(w.start())


@contextmanager
def computed_once(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch for several actions, held on disk: each action on a batch itself runs its stateful operators anew."""
    held = batch.persist(StorageLevel.DISK_ONLY)
    try:
        yield held
    finally:
        held.unpersist()


# Keyed state in RocksDB: its files are on the executors' disks, all partitions of an executor share one bound on memory
# (outside the heap), and a commit stores the batch's changes.  Counting all rows would add a read to each new key.
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.maxMemoryUsageMB": "400",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """New stream runs started here keep their state on disk: for keys that grow with the input, which the default store
    holds in the executors' heap, two versions at a time."""
    before = {k: spark.conf.get(k, None) for k in DISK_STATE}
    try:
        for k, v in DISK_STATE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def batch_partition_writer(path: str, guard_empty: bool = True) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: overwrite ``path/batch_id=<id>`` with the batch (idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with computed_once(batch) as rows:
            if guard_empty and rows.isEmpty():   # nothing arrived: write nothing
                return
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def read_changelog(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Compact an update-mode changelog: the row of the latest batch per key."""
    log = spark.read.parquet(path)
    cols = [c for c in log.columns if c not in set(keys) | {"batch_id"}]
    # a max_by per column: numbers and times are then aggregated by hashing, a struct of them only by sorting
    return log.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in cols])


def run_update_aggregate(spark: SparkSession, agg: DataFrame, keys: Sequence[str], name: str,
                         disk_state: bool = False) -> DataFrame:
    """Run a streaming aggregate in update mode to completion; return its final table."""
    out = scratch_path(spark, f"{name}-out")
    with state_on_disk(spark) if disk_state else nullcontext():
        run_available_now(agg, batch_partition_writer(out), scratch_path(spark, f"{name}-ckpt"), mode="update")
    return read_changelog(spark, out, keys)


def run_append(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run an append-only stream (projection, stream-static join) to completion; return all rows."""
    out = scratch_path(spark, f"{name}-out")
    run_available_now(stream, batch_partition_writer(out), scratch_path(spark, f"{name}-ckpt"))
    return spark.read.parquet(out).drop("batch_id")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    The static side of a stream-static join is re-evaluated every micro-batch;
    a model or lookup table computed from a large table is therefore written
    once (like a saved model) so that batches only read the small result.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def event_time(col: str) -> Column:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``); session time zone is UTC."""
    return F.col(col).cast("timestamp")


def ntz(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")


__all__ = ["stream_source", "stage_files", "file_stream", "run_available_now", "batch_partition_writer",
           "read_changelog", "run_update_aggregate", "run_append", "materialize", "start", "event_time", "ntz",
           "Staged", "most_files", "state_on_disk"]
