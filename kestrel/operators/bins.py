"""Mergeable histograms of any doubles: order-preserving bins of a fixed relative width.

A bin's number depends on the value alone, so counts per (key, bin) merge by
addition - over tasks, slots or windows - without a pass for split points, and
the bin that holds a rank bounds the value of that rank to half a percent.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 0.005                    # a bin's upper end over its lower end, less one
FINE = 1024                      # fine bins in a bin

_STEPS = FINE / math.log1p(WIDTH)
# Beyond the logarithm of the smallest and the largest double.
_REACH = math.ceil(750 * _STEPS)


def fine_bin(value: str | Column) -> Column:
    """Whole number that never falls as the value rises; NaN is above all numbers, null stays null."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    size = F.floor(F.least(F.log(F.abs(x)), F.lit(745.0)) * _STEPS) + _REACH       # log is monotone, so is its floor
    return (F.when(F.isnan(x), F.lit(3 * _REACH)).when(x > 0, size).when(x < 0, -size)
            .when(x.isNotNull(), F.lit(0)).cast("long"))


def coarse_bin(fine: str | Column) -> Column:
    """The bin of a fine bin."""
    return F.floor((F.col(fine) if isinstance(fine, str) else fine) / FINE)


def log_bin(value: str | Column) -> Column:
    """Bin of a value: see :func:`fine_bin`."""
    return coarse_bin(fine_bin(value))
