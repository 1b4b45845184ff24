"""Splitting delimited text into typed, named columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_literal(col, delim: str) -> Column:
    """``str.split(delim)`` semantics: the delimiter is literal, empty fields kept."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, re.escape(delim), -1)


def name_fields(df: DataFrame, parts: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Positional fields → named string columns (missing fields become NULL)."""
    return df.select(*keep, *[F.try_element_at(F.col(parts), F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def typed_customer(df: DataFrame) -> DataFrame:
    """Cast the named customer fields (untrusted text → ``try_cast``)."""
    return df.select(
        *[c for c in df.columns if c not in {"tstamp", "dob", "housingCosts", "childCareCosts"}],
        F.timestamp_seconds(F.col("tstamp").try_cast("long")).cast("timestamp_ntz").alias("tstamp"),
        F.col("dob").try_cast("date").alias("dob"),
        F.col("housingCosts").try_cast("double").alias("housingCosts"),
        F.col("childCareCosts").try_cast("double").alias("childCareCosts"))
