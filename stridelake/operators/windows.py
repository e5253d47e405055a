"""Ordered window functions of one session: differences, rolling statistics, shares and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators.ranges import KEY, SEQ, by_seq


def first_diff(column: str, first: float, key: str = KEY, seq: str = SEQ) -> Column:
    """Difference to the sample before; the first sample gets ``first``."""
    return F.coalesce(F.col(column) - F.lag(column).over(by_seq(key, seq)), F.lit(first))


def reset_outlier(diff: Column, bound: float) -> Column:
    """A jump over ``bound`` counts as none (an angle that wraps)."""
    return F.when(F.abs(diff) > bound, F.lit(0.0)).otherwise(diff)


def rolling_std(column: str, before: int, after: int, least: int, key: str = KEY, seq: str = SEQ) -> Column:
    """Sample deviation of the window; null with fewer than ``least`` values or at a null."""
    w = by_seq(key, seq).rowsBetween(-before, after)
    return F.when((F.count(column).over(w) >= least) & F.col(column).isNotNull(), F.stddev_samp(column).over(w))


def mean3_edges(column: str, key: str = KEY, seq: str = SEQ) -> Column:
    """Mean of three neighbours; the first and last sample keep their values."""
    w = by_seq(key, seq)
    inner = F.lag(column).over(w).isNotNull() & F.lead(column).over(w).isNotNull()
    return F.when(inner, F.avg(column).over(w.rowsBetween(-1, 1))).otherwise(F.col(column))


def cumulative_share(column: str, key: str = KEY, seq: str = SEQ) -> Column:
    """Running total over the session's total; nulls count as nothing."""
    filled = F.coalesce(F.col(column), F.lit(0.0))
    return F.sum(filled).over(by_seq(key, seq).rowsBetween(Window.unboundedPreceding, 0)) / F.sum(filled).over(Window.partitionBy(key))


def forward_fill(column: str | Column, key: str = KEY, seq: str = SEQ) -> Column:
    """The last value that is not null, this sample's included; null before the first."""
    return F.last(column, ignorenulls=True).over(by_seq(key, seq).rowsBetween(Window.unboundedPreceding, 0))


def average_rank(column: str, *keys: str) -> Column:
    """Rank from 1 with ties sharing their mean rank."""
    w = Window.partitionBy(*keys).orderBy(column)
    return F.rank().over(w) + (F.count("*").over(Window.partitionBy(*keys, column)) - 1) / 2


def local_peaks(column: str, least: float | None = None, key: str = KEY, seq: str = SEQ) -> Column:
    """Rising edge peaks: over the sample before, not under the next; ends and nulls are none."""
    w = by_seq(key, seq)
    peak = (F.col(column) > F.lag(column).over(w)) & (F.col(column) >= F.lead(column).over(w))
    return F.coalesce(peak if least is None else peak & (F.col(column) >= least), F.lit(False))


def last_static_window(df: DataFrame, still: Column, size: int, least: int, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """The start of the last window of ``size`` samples with at least ``least`` still ones."""
    w = by_seq(key, seq).rowsBetween(-(size - 1), 0)
    counted = df.withColumn("_still", F.sum(still.cast("int")).over(w)).withColumn("_n", F.count("*").over(w))
    return counted.where((F.col("_n") == size) & (F.col("_still") >= least)).groupBy(key).agg((F.max(seq) - size + 1).alias("start"))


def control_score(column: str, cap: float, key: str = KEY, seq: str = SEQ) -> Column:
    """100 at no spread of 13 samples, 0 at ``cap`` or more."""
    return 100 * (1 - F.least(F.greatest(rolling_std(column, 6, 6, 5, key, seq), F.lit(0.0)), F.lit(cap)) / cap)


def interpolate(column: str, at: str, key: str = KEY, seq: str = SEQ) -> Column:
    """Linear interpolation of a sparse series over ``at``; constant beyond its ends."""
    back = by_seq(key, seq).rowsBetween(Window.unboundedPreceding, 0)
    ahead = by_seq(key, seq).rowsBetween(0, Window.unboundedFollowing)
    there = F.when(F.col(column).isNotNull(), F.col(at))
    y0, x0 = F.last(column, True).over(back), F.last(there, True).over(back)
    y1, x1 = F.first(column, True).over(ahead), F.first(there, True).over(ahead)
    return F.coalesce(F.when(x1 == x0, y0).otherwise(y0 + (y1 - y0) * (F.col(at) - x0) / (x1 - x0)), y0, y1)
