"""Input tables and tokenizer files of the training-data queries."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def make_importable(spark: SparkSession) -> None:
    """Prepare the session for Python workers on long texts.

    Workers can import this package when the driver found it beside its own
    script (this only names a folder in their search path; on a cluster the
    package comes with ``--py-files`` or is installed, and the folder is simply
    absent).  Arrow batches get 1,000 rows instead of Spark's default 10,000,
    unless the session sets its own number: texts are large, and both sides of
    the exchange hold a whole batch.
    """
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, _ROOT])


def named(column: str) -> Column:
    """A column by its very name, dots and blanks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh_names(columns: list[str], *wanted: str) -> dict[str, str]:
    """A name per wanted helper column that no given column has in upper or lower case."""
    taken, out = {c.lower() for c in columns}, {}
    for name in wanted:
        fresh = f"__{name.lower()}"
        while fresh in taken:
            fresh += "_"
        taken.add(fresh)
        out[name] = fresh
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table through Spark's reader (any file system)."""
    make_importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of an installed public tokenizer on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
