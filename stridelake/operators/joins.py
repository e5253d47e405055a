"""Interval, band and as-of joins as equi-joins on buckets with residual conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def band_join(left: DataFrame, right: DataFrame, keys: list[str], l_at: str, r_at: str, width: float) -> DataFrame:
    """Pairs with equal keys and ``abs(l_at - r_at) <= width``.

    Both sides are bucketed by the width; the left row looks into its own bucket and the two
    beside it, so the join is an equi-join and each pair is found once.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    near = left.withColumn("_bucket", F.explode(F.array(*(bucket(l_at) + d for d in (-1, 0, 1)))))
    return near.join(right.withColumn("_bucket", bucket(r_at)), [*keys, "_bucket"]).where(F.abs(F.col(l_at) - F.col(r_at)) <= width).drop("_bucket")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], pad: int, width: int) -> DataFrame:
    """Pairs of ranges (``l_start, l_end`` and ``r_start, r_end``) that overlap after padding.

    Each range is exploded over the buckets that it touches; a pair counts in the first
    bucket that both touch.
    """

    def over(df: DataFrame, start: Column, end: Column) -> DataFrame:
        return df.withColumn("_bucket", F.explode(F.sequence(F.floor(start / width), F.floor((end - 1) / width))))

    l = over(left, F.col("l_start") - pad, F.col("l_end") + pad)  # noqa: E741
    r = over(right, F.col("r_start") - pad, F.col("r_end") + pad)
    met = l.join(r, [*keys, "_bucket"]).where((F.col("l_start") - pad < F.col("r_end") + pad) & (F.col("r_start") - pad < F.col("l_end") + pad))
    first = F.floor(F.greatest(F.col("l_start") - pad, F.col("r_start") - pad) / width)
    return met.where(F.col("_bucket") == first).drop("_bucket")


def near_points(points: DataFrame, marks: DataFrame, keys: list[str], at: str, mark: str, before: int, after: int) -> DataFrame:
    """Semi-join: points with a mark in [at - before, at + after], by one window over both."""
    w = Window.partitionBy(*keys).orderBy("_at", "_kind")
    both = points.withColumn("_at", F.col(at)).withColumn("_kind", F.lit(1)).unionByName(
        marks.select(*keys, F.col(mark).alias("_at")).withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    seen = F.when(F.col("_kind") == 0, F.col("_at"))
    last = F.max(seen).over(w.rowsBetween(Window.unboundedPreceding, 0))
    following = F.min(seen).over(w.rowsBetween(0, Window.unboundedFollowing))
    marked = both.withColumn("_last", last).withColumn("_next", following).where("_kind = 1")
    return marked.where((F.col("_at") - F.col("_last") <= before) | (F.col("_next") - F.col("_at") <= after)).drop("_at", "_kind", "_last", "_next")


def interval_match(ranges: DataFrame, points: DataFrame, keys: list[str], width: int) -> DataFrame:
    """1:1 match of points to the ranges (``start``, ``end``) that hold them.

    A point goes to the first range that holds it, and a range keeps its first point.  For
    ranges that do not overlap this is what a queue would match.
    """
    spread = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    met = spread.join(points.withColumn("_bucket", F.floor(F.col("at") / width)), [*keys, "_bucket"]).where("at >= start AND at <= end").drop("_bucket")
    per_point = Window.partitionBy(*keys, "at").orderBy("start")
    per_range = Window.partitionBy(*keys, "start").orderBy("at")
    return met.withColumn("_p", F.row_number().over(per_point)).where("_p = 1").withColumn("_r", F.row_number().over(per_range)).where("_r = 1").drop("_p", "_r")


def anchored_buckets(samples: DataFrame, width: int, least: int, key: str = "session_id") -> DataFrame:
    """Buckets of ``width`` from each block's first sample (``session_id, block, at``), with their number of samples.

    Both ends count, so a sample on a boundary is in two buckets; buckets under ``least`` are
    left out.  A gap of more than ``least`` between a block and the one before gives blank
    buckets, those of more than ``least``.
    """
    at = F.col("at")
    blocks = samples.groupBy(key, "block").agg(F.min("at").alias("_a"), F.max("at").alias("_b"))
    edge = lambda end: F.least(F.col("start") + width, F.col(end))
    placed = samples.join(blocks, [key, "block"]).withColumn("_k", F.floor((at - F.col("_a")) / width).cast("long"))
    on_edge = (at > F.col("_a")) & ((at - F.col("_a")) % width == 0)
    own = placed.withColumn("_k", F.explode(F.when(on_edge, F.array(F.col("_k") - 1, F.col("_k"))).otherwise(F.array("_k")))).withColumn("start", F.col("_a") + F.col("_k") * width)
    own = own.where("start < _b").withColumn("stop", edge("_b")).where(F.col("stop") - F.col("start") >= least)
    filled = own.groupBy(key, "start", "stop").agg(F.lit(False).alias("is_blank"), F.count(F.lit(1)).alias("n_samples"))
    before = F.lag("_b").over(Window.partitionBy(key).orderBy("block"))
    gaps = blocks.where("_b > _a").withColumn("_from", before).where(F.col("_a") - F.col("_from") > least)
    starts = gaps.select(key, F.explode(F.sequence(F.col("_from"), F.col("_a") - 1, F.lit(width))).alias("start"), F.col("_a").alias("_to"))
    blank = starts.withColumn("stop", edge("_to")).where(F.col("stop") - F.col("start") > least).select(key, "start", "stop", F.lit(True).alias("is_blank"), F.lit(0).cast("long").alias("n_samples"))
    return filled.unionByName(blank)


def queue_match(ranges: DataFrame, points: DataFrame, key: str = "session_id") -> DataFrame:
    """1:1 match of a queue of points (``at, pitch``) with ranges (``start, end``) in order of their starts.

    A range purges the points before its start from the queue's head, then consumes the head if it lies
    inside.  The queue is state from range to range, so a session is one sorted group.
    """
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        at = table.column("at").to_numpy()
        order = np.lexsort((at, kind))
        table = table.take(pa.array(order))
        n = int((kind == 0).sum())
        time, stop, pitch = (table.column(c).to_pylist() for c in ("at", "stop", "pitch"))
        rows, head = [], n
        session = table.column(key)[0].as_py()
        for i in range(n):
            while head < len(time) and time[head] < time[i]:
                head += 1
            if head < len(time) and time[head] <= stop[i]:
                rows.append((session, time[i], stop[i], time[head], pitch[head]))
                head += 1
        columns = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (table.schema.field(key).type, pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=[key, "start", "end", "at", "pitch"])

    one = ranges.select(key, F.lit(0).alias("kind"), F.col("start").alias("at"), F.col("end").alias("stop"), F.lit(None).cast("double").alias("pitch"))
    both = one.unionByName(points.select(key, F.lit(1).alias("kind"), "at", F.lit(None).cast("long").alias("stop"), F.col("pitch").cast("double")))
    return both.groupBy(key).applyInArrow(run, f"{key} {dict(ranges.dtypes)[key]}, start long, end long, at long, pitch double")
