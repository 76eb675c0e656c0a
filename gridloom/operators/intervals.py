"""Joins of points with the intervals they lie in.

An interval goes to the bins of a level that fits it: bins as wide as the interval or up to four times that, so it meets
two of them at most, whatever its length. A point goes to its one bin on every level that some interval is on. They meet
by equality of the keys, the level and the bin, and the bounds are tested on what has met. Where all intervals are of much
the same length, as in a band join, there is one level, and points are not multiplied at all. A hot key is dealt out by
bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.columns import free

#: Bins of a level are this many times as wide as those of the level below.
STEP = 4
#: The widest level: its bins are wider than any range of 64-bit numbers that is looked at.
LEVELS = 31


def _bin_of(value: Column, level: Column) -> Column:
    """The number of the value's bin: the value without its lowest bits, so rounded down for negative ones too."""
    out = F.shiftright(value, 2 * LEVELS)
    for n in range(LEVELS):
        out = F.when(level == n, F.shiftright(value, 2 * n)).otherwise(out)
    return out


def interval_join(points: DataFrame, intervals: DataFrame, on: Sequence[str], point: str, low: str, high: str) -> DataFrame:
    """Columns of both for each point and interval with equal ``on`` and ``low <= point <= high``; integers of up to 62
    bits, null bounds and points meet nothing, and so do intervals that end before they begin."""
    level, bin_ = (free(intervals, free(points, name)) for name in ("_level", "_bin"))
    there = intervals.where(F.col(low) <= F.col(high))
    length = F.col(high).cast("long") - F.col(low).cast("long") + 1
    fitting = F.lit(LEVELS)
    for n in range(LEVELS - 1, -1, -1):
        fitting = F.when(length <= F.lit(STEP**n), n).otherwise(fitting)
    levelled = there.withColumn(level, fitting.cast("int"))
    at = lambda c: _bin_of(F.col(c).cast("long"), F.col(level))
    binned = levelled.withColumn(bin_, F.explode(F.array_distinct(F.array(at(low), at(high)))))
    used = sorted(r[0] for r in levelled.select(level).distinct().collect())  # 32 at most
    everywhere = points.where(F.col(point).isNotNull()).withColumn(level, F.explode(F.array(*[F.lit(n) for n in used]).cast("array<int>")))
    met = everywhere.withColumn(bin_, at(point)).join(binned, [*on, level, bin_])
    return met.where(F.col(point).between(F.col(low), F.col(high))).drop(level, bin_)
