"""Placement of sensors: names by side, yaw fixes by code, decisions and their accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions import quaternion as Q

#: Yaw errors in degrees (left, right) by placement code, and of every other code.
YAW_FIXES = {
    "ACE": (-105.0, -75.0), "ADE": (75.0, 105.0), "BCE": (75.0, 105.0), "BDE": (-105.0, -75.0),
    "ACF": (-22.5, -157.5), "ADF": (157.5, 22.5), "BCF": (157.5, 22.5), "BDF": (-22.5, -157.5),
}
YAW_DEFAULT = 90.0
SKEW_LEAST = 0.35


def rename_placed(df: DataFrame, placement: list[int]) -> DataFrame:
    """Column names with sensor numbers get sides: the sensors of left, hip and right are given."""
    side = dict(zip(map(str, placement), ("lf", "hip", "rf")))
    new = {c: "_".join(side.get(part, part) for part in c.split("_")) for c in df.columns}
    return df.withColumnsRenamed(new)


def fix_yaw(q: tuple[Column, ...], code: Column, foot: Column, reverse: bool = False) -> tuple[Column, ...]:
    """An orientation without the yaw error that its placement code and foot stand for (or with it, reversed)."""
    angle = F.lit(YAW_DEFAULT)
    for name, (left, right) in YAW_FIXES.items():
        angle = F.when(code == name, F.when(foot == "left", left).otherwise(right)).otherwise(angle)
    half = F.radians(angle) / 2
    error = (F.cos(half), F.lit(0.0), F.lit(0.0), F.sin(half))
    return Q.product(q, error if reverse else Q.inverse(error))


def left_by_skew(first: Column, second: Column) -> Column:
    """Is the first foot left, by the skewness of the pitches of both?"""
    return F.when((first < -SKEW_LEAST) & (second > SKEW_LEAST), "left").when((first > SKEW_LEAST) & (second < -SKEW_LEAST), "right").otherwise("undecided")


def accuracy(results: DataFrame, expected: str, answer: str) -> DataFrame:
    """Right answers by expected code, in percent."""
    right = F.count_if(F.col(expected) == F.col(answer))
    return results.groupBy(F.col(expected).alias("code")).agg(F.count(F.lit(1)).alias("n"), F.round(100.0 * right / F.count(F.lit(1)), 6).alias("perc_correct"))


def train(values: DataFrame, conditions: DataFrame, bin_: Column) -> DataFrame:
    """Histograms (percent) of labelled values (``label, sensor, v``) for each condition of a label and both sensor orders.

    ``conditions`` is the fixed map of labels; it is small and broadcast under Spark's own size check.
    """
    met = values.join(conditions, "label").withColumn("bin", bin_)
    counts = met.groupBy("condition", "sensor", "bin").agg(F.count(F.lit(1)).alias("n"))
    orders = F.explode(F.array(F.struct(F.lit("012").alias("sensor_order"), F.col("sensor").alias("foot")), F.struct(F.lit("210").alias("sensor_order"), (1 - F.col("sensor")).alias("foot"))))
    both = counts.select("condition", orders.alias("o"), "bin", "n").select("condition", "o.*", "bin", "n")
    whole = Window.partitionBy("condition", "sensor_order", "foot")
    return both.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(whole), 6))
