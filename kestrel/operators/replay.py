"""Replay-feed helpers: repeat-timestamp suppression and inter-arrival pacing.

A feed is ordered by a line number *within a source*.  Both operators look at
the previous row of the source; the window runs per block of lines, so a source
of any size spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.sequence import previous_in_sequence

BLOCK_LINES = 100_000


def _with_previous(df: DataFrame, source: str, line_no: str, ts: str, block: int) -> DataFrame:
    blocked = df.withColumn("_block", F.floor(F.col(line_no) / block))
    return previous_in_sequence(blocked, source, "_block", [line_no], ts, "_prev").drop("_block")


def drop_repeat_timestamps(df: DataFrame, source: str, line_no: str, ts: str,
                           keep_first: bool = True, block: int = BLOCK_LINES) -> DataFrame:
    """Drop rows whose timestamp equals that of the previous (kept) row.

    ``keep_first=False`` reproduces the original feeder, which also skipped
    the first data row of every file.
    """
    out = _with_previous(df, source, line_no, ts, block)
    cond = F.col("_prev").isNull() | (F.col(ts) != F.col("_prev"))
    if not keep_first:
        cond = F.col("_prev").isNotNull() & (F.col(ts) != F.col("_prev"))
    return out.where(cond).drop("_prev")


def replay_schedule(df: DataFrame, source: str, line_no: str, ts: str, speedup: int = 1,
                    wrap_days: bool = False, block: int = BLOCK_LINES) -> DataFrame:
    """Seconds since the previous row and the paced sleep ``gap // speedup``.

    ``wrap_days=True`` keeps only the seconds-within-a-day part of the gap, as
    ``timedelta.seconds`` did in the original feeder.
    """
    gap = F.unix_timestamp(F.col(ts)) - F.unix_timestamp(F.col("_prev"))
    if wrap_days:
        gap = F.pmod(gap, F.lit(86400))
    out = _with_previous(df, source, line_no, ts, block).withColumn("gap_seconds", gap.cast("long")).drop("_prev")
    return out.withColumn("sleep_seconds", F.floor(F.col("gap_seconds") / speedup).cast("long"))
