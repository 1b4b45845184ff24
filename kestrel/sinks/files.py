"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_fields(cols: Sequence[str], sep: str) -> Column:
    """Fields as strings joined by ``sep``; a NULL is an empty field, so later fields keep their place."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def write_delimited_text(df: DataFrame, path: str, cols: Sequence[str], sep: str) -> None:
    """One ``sep``-joined line per row (no quoting), overwrite."""
    df.select(joined_fields(cols, sep).alias("value")) \
        .write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", quote: str = '"',
              single_file: bool = False) -> None:
    """CSV with header, overwrite.  ``single_file`` funnels through one task —
    meant for small final reports only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).option("sep", sep).option("quote", quote).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def encode_delimited(df: DataFrame, cols: Sequence[str], sep: str, name: str = "value") -> DataFrame:
    """Kafka-style message value: fields joined by ``sep``."""
    return df.select(joined_fields(cols, sep).alias(name))


def encode_json_array(df: DataFrame, cols: Sequence[str], name: str = "value") -> DataFrame:
    """Kafka-style message value: a JSON array of the fields as strings."""
    return df.select(F.to_json(F.array(*[F.col(c).cast("string") for c in cols])).alias(name))
