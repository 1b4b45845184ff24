"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every kestrel job relies on: UTC wall clock (the oracle and the
# test data are time-zone naive) and adaptive execution for runtime re-planning
# (partition coalescing, skew-join splitting, broadcast conversion).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "kestrel", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with kestrel's core settings.

    On a cluster pass ``master=None`` and let spark-submit decide; the number
    of shuffle partitions is then left to the cluster default / AQE.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_SCRATCH: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root of shared storage for checkpoints and materialised tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when it is unset on a
    ``local[...]`` master (unit tests, a laptop) a private temporary folder is
    created and registered as the checkpoint directory; on a cluster such a
    folder would be another one on every machine, so that raises.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH["dir"] = tempfile.mkdtemp(prefix="kestrel-")
        sc.setCheckpointDir(os.path.join(_LOCAL_SCRATCH["dir"], "rdd"))
    return _LOCAL_SCRATCH["dir"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared directory (never reused)."""
    return f"{shared_dir(spark)}/kestrel/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the path's own file system; storage errors are raised."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def count_files(spark: SparkSession, pattern: str) -> int:
    """How many files match a glob pattern on its own file system; storage errors are raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return len(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or ())
