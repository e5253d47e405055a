"""Rates of force and rotations of a contact, as windows and column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators.ranges import KEY, SEQ, by_seq, with_runs


def absorption(df: DataFrame, flag: Column, force: str, double_leg: Column, rate: float, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Samples of the impacts with ``rate``: the rise from the sample before the first force to the peak, a second.

    0 where the force does not rise, or the first force is the session's first sample; halved in double stances.
    """
    runs = with_runs(df.withColumn("_before", F.lag(force).over(by_seq(key, seq))), flag, key, seq).where("_flag")
    run = Window.partitionBy(key, "_run")
    first = F.min(F.when(F.col(force) != 0, F.col(seq))).over(run)
    low = F.min_by("_before", F.when(F.col(force) != 0, F.col(seq))).over(run)
    high, top = F.max(force).over(run), F.max_by(seq, F.struct(F.col(force), -F.col(seq))).over(run)
    rises = (first > 0) & (high > low) & (top > first - 1)
    value = F.coalesce(F.when(rises, (high - low) / ((top - first + 1) / rate)), F.lit(0.0))
    return runs.withColumn("rate", value / F.when(double_leg, 2.0).otherwise(1.0)).drop("_flag", "_run", "_before")


def production(df: DataFrame, flag: Column, force: str, double_leg: Column, rate: float, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Samples of the take-offs with ``rate``: the change from the peak to the first zero after it, a second.

    Without a zero the change goes to the sample after the lowest one; the session's last
    sample is the last end.  0 if nothing lies between; halved in double stances.
    """
    ahead = df.withColumn("_next", F.lead(force).over(by_seq(key, seq))).withColumn("_last", F.max(seq).over(Window.partitionBy(key)))
    runs = with_runs(ahead, flag, key, seq).where("_flag")
    run = Window.partitionBy(key, "_run")
    peaked = runs.withColumn("_top", F.max_by(seq, F.struct(F.col(force), -F.col(seq))).over(run)).withColumn("_high", F.max(force).over(run))
    after = F.col(seq) >= F.col("_top")
    zero = F.min(F.when(after & (F.col(force) == 0), F.col(seq))).over(run)
    lowest = F.min_by(F.struct(F.col(seq), F.coalesce("_next", F.col(force)).alias("v")), F.when(after, F.struct(F.col(force), F.col(seq)))).over(run)
    stop = F.when(zero.isNotNull(), zero).otherwise(F.least(lowest[seq] + 1, F.col("_last")))
    end = F.when(zero.isNotNull(), F.lit(0.0)).otherwise(lowest["v"])
    value = F.when(stop > F.col("_top"), F.abs(end - F.col("_high")) / ((stop - F.col("_top")) / rate)).otherwise(0.0)
    return peaked.withColumn("rate", value / F.when(double_leg, 2.0).otherwise(1.0)).drop("_flag", "_run", "_next", "_last", "_top", "_high")


def rotation_on_ground(angle: Column, reference: Column | None, phase: Column, sign: int) -> Column:
    """Rotation about one axis against a reference angle (neutral if none), in degrees; null in the air.

    Two rotations about the same axis differ by the difference of their angles, taken the short way.
    """
    moved = angle if reference is None else angle - reference
    return F.when(phase.isin(0, 2, 3), F.degrees(F.atan2(F.sin(moved), F.cos(moved))) * sign)
