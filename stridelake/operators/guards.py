"""Checks of sessions and uploads: each gives rows with a code, so that failures go to a table, not to an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators.ranges import KEY, SEQ, ranges

#: Fixed value: an upload that ends in these characters is void.
VOID_END = "!!!!!"


def start_guard(samples: DataFrame, dates: DataFrame, at: str, within: float, key: str = KEY) -> DataFrame:
    """``code`` per session: NO_DATA if it has no sample from its date on or starts too late after it, else null."""
    own = samples.join(dates, key).where(F.col(at) >= F.col("event_at"))
    first = own.groupBy(key).agg(F.min(at).alias("first_at"))
    found = dates.join(first, key, "left")
    late = F.col("first_at").isNull() | (F.col("first_at") - F.col("event_at") > within)
    return found.select(key, "first_at", F.when(late, F.lit("NO_DATA")).alias("code"))


def minimum_rows(samples: DataFrame, least: int, key: str = KEY) -> DataFrame:
    """``n`` and ``code`` per session: TOO_SHORT under ``least`` rows, else null."""
    counted = samples.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("code", F.when(F.col("n") < least, "TOO_SHORT"))


def mask_inactive(df: DataFrame, stance: str, active: str, phase_lf: str, phase_rf: str, force: str) -> DataFrame:
    """Activity without stance 0, indicators of contact, and the force where they hold (0 elsewhere; null stays null)."""
    on = (F.col(active) == 1) & (F.col(stance) != 0)
    ground = lambda c: on & F.col(c).isin(0, 2, 3)
    total, lf, rf = on & ~F.col(stance).isin(0, 1), ground(phase_lf), ground(phase_rf)
    kept = lambda c: F.col(force) * c.cast("int")
    return df.withColumns({
        "active": on.cast("int"), "total_ind": total.cast("int"), "lf_ind": lf.cast("int"), "rf_ind": rf.cast("int"),
        "total_grf": kept(total), "lf_grf": kept(lf), "rf_grf": kept(rf), "lf_only_grf": kept(lf & ~rf), "rf_only_grf": kept(~lf & rf),
    })


def upload_code(body: Column, source: Column, bucket: str) -> Column:
    """VOID_END, BAD_SOURCE or null; ``bucket`` is a pattern of allowed bucket names."""
    well = source.rlike(rf"^s3://(?:{bucket})/.+$")
    return F.when(F.substring(body, -5, 5) == VOID_END, "VOID_END").when(source.isNotNull() & ~well, "BAD_SOURCE")


def bad_step(pitch: Column) -> Column:
    """A step whose highest pitch comes before its lowest is no good step; a step without samples neither."""
    return F.coalesce(F.array_position(pitch, F.array_max(pitch)) < F.array_position(pitch, F.array_min(pitch)), F.lit(True))


def quality_alerts(samples: DataFrame, first: int = 101, level: float = 30.0, longer: int = 10, more: int = 5, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Per session the most runs (longer than ``longer``) of a sensor's ``x`` at ``level`` over the mean of its
    ``first`` samples, with an alert if a sensor has more than ``more``.
    """
    one = samples.withColumn("_sensor", F.struct(key, "sensor"))
    base = F.avg(F.when(F.col(seq) < first, F.col("x"))).over(Window.partitionBy("_sensor"))
    high = one.withColumn("_over", F.col("x") - base >= level)
    found = ranges(high, F.col("_over"), "drop_last", "_sensor", seq).where(F.col("length") > longer)
    runs = found.groupBy("_sensor").agg(F.count(F.lit(1)).alias("n_runs"))
    return runs.groupBy(F.col(f"_sensor.{key}").alias(key)).agg(F.max("n_runs").alias("n_runs")).withColumn("alert", F.col("n_runs") > more)
