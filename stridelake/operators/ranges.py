"""Run-length ranges, gap filling and sessionization, all as windows over one sort.

Every function partitions by the session and orders by ``seq``; chained calls share the
exchange and the sort.  Ranges are half-open ``[start, end)`` in sample numbers from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, SEQ = "session_id", "seq"


def by_seq(key: str = KEY, seq: str = SEQ):
    return Window.partitionBy(key).orderBy(seq)


def with_runs(df: DataFrame, flag: Column, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Adds ``_flag`` and ``_run``, the number of the maximal run of equal flags."""
    w = by_seq(key, seq)
    flagged = df.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    change = F.when(F.col("_flag") == F.lag("_flag").over(w), 0).otherwise(1)
    return flagged.withColumn("_change", change).withColumn("_run", F.sum("_change").over(w)).drop("_change")


def ranges(df: DataFrame, flag: Column, closed_end: str = "exact", key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Maximal runs where ``flag`` holds: ``start, end, length`` per session.

    ``closed_end="drop_last"`` applies the closing-edge rule: a run that reaches the last
    sample ends before it, and a run of the last sample alone is dropped.
    """
    if closed_end not in ("exact", "drop_last"):
        raise ValueError("closed_end must be 'exact' or 'drop_last'")
    runs = with_runs(df, flag, key, seq)
    whole = runs.withColumn("_n", F.max(seq).over(Window.partitionBy(key)) + 1)
    out = whole.where("_flag").groupBy(key, "_run").agg(F.min(seq).alias("start"), (F.max(seq) + 1).alias("end"), F.first("_n").alias("_n"))
    if closed_end == "drop_last":
        out = out.withColumn("end", F.when(F.col("end") == F.col("_n"), F.col("_n") - 1).otherwise(F.col("end"))).where("end > start")
    return out.select(key, "start", "end", (F.col("end") - F.col("start")).alias("length"))


def fill_short_runs(df: DataFrame, column: str, value: int, shorter: int, new: int, closed_end: str = "drop_last", key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Runs of ``value`` shorter than ``shorter`` take the value ``new``.

    With the closing-edge rule the last sample of a run at the end keeps its value and does
    not count.  Chained calls see each other's results, so the order matters.
    """
    runs = with_runs(df, F.col(column) == value, key, seq)
    run = Window.partitionBy(key, "_run")
    n = F.max(seq).over(Window.partitionBy(key)) + 1
    end = F.max(seq).over(run) + 1
    if closed_end == "drop_last":
        end = F.when(end == n, n - 1).otherwise(end)
    short = F.col("_flag") & (F.col(seq) < end) & (end - F.min(seq).over(run) < shorter)
    return runs.withColumn(column, F.when(short, F.lit(new)).otherwise(F.col(column))).drop("_flag", "_run")


def merge_ranges(found: DataFrame, gap: int, strict: bool = False, key: str = KEY) -> DataFrame:
    """Active blocks: ranges whose gap is at most ``gap`` (or under it, if strict) are one."""
    w = Window.partitionBy(key).orderBy("start")
    apart = F.col("start") - F.lag("end").over(w)
    new = F.when((apart >= gap) if strict else (apart > gap), 1).otherwise(0)
    numbered = found.withColumn("_new", new).withColumn("block", F.sum("_new").over(w))
    return numbered.groupBy(key, "block").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_ranges")).withColumn("block", F.col("block").cast("long"))


def sessionize(df: DataFrame, at: str, gap: int, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Adds ``block``: a new one starts when more than ``gap`` lies between neighbours."""
    w = by_seq(key, seq)
    new = F.when(F.col(at) - F.lag(at).over(w) > gap, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("block", F.sum("_new").over(w).cast("long")).drop("_new")


def cut_at_changes(df: DataFrame, column: str, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Adds ``unit``, which grows wherever ``column`` differs from the sample before."""
    w = by_seq(key, seq)
    new = F.when(F.lag(column).over(w).isNotNull() & ~F.lag(column).over(w).eqNullSafe(F.col(column)), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("unit", F.sum("_new").over(w).cast("long")).drop("_new")


def between_points(steps: DataFrame, points: DataFrame, more_than: int, key: str = KEY) -> DataFrame:
    """Intervals between neighbouring points that hold more than so many whole steps.

    A range join on the session: each step is put to the interval that its start falls in
    by a union and one window, so no pairs are made.
    """
    w = Window.partitionBy(key).orderBy("pos", "kind")
    marks = points.select(key, F.col("seq").alias("pos"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("end"))
    events = steps.select(key, F.col("start").alias("pos"), F.lit(0).alias("kind"), "end").unionByName(marks)
    placed = events.withColumn("lo", F.max(F.when(F.col("kind") == 1, F.col("pos"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    ahead = F.min(F.when(F.col("kind") == 1, F.col("pos"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    inside = placed.withColumn("hi", ahead).where("kind = 0 AND lo IS NOT NULL AND hi IS NOT NULL AND pos > lo AND end < hi")
    return inside.groupBy(key, "lo", "hi").agg(F.count("*").alias("n_steps")).where(F.col("n_steps") > more_than)


def flag_intervals(samples: DataFrame, intervals: DataFrame, bridge: int, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Adds ``remove``: 1 inside the intervals [lo, hi), and in gaps between them under ``bridge`` samples."""
    marks = intervals.select(key, F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias(seq), F.lit(1).alias("remove"))
    flagged = samples.join(marks.dropDuplicates([key, seq]), [key, seq], "left").withColumn("remove", F.coalesce("remove", F.lit(0)))
    return fill_short_runs(flagged, "remove", 0, bridge, 1, "drop_last", key, seq)


def drop_quiet_runs(df: DataFrame, column: str, longer: int, strong: Column, share: float, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Runs of 1 longer than ``longer`` become 0 if under ``share`` of their samples are strong."""
    runs = with_runs(df, F.col(column) == 1, key, seq)
    run = Window.partitionBy(key, "_run")
    n = F.max(seq).over(Window.partitionBy(key)) + 1
    end = F.max(seq).over(run) + 1
    end = F.when(end == n, n - 1).otherwise(end)
    inside = F.col(seq) < end
    part = F.avg(F.when(inside, F.when(strong, 1.0).otherwise(0.0))).over(run)
    quiet = F.col("_flag") & inside & (end - F.min(seq).over(run) > longer) & (part < share)
    return runs.withColumn(column, F.when(quiet, F.lit(0)).otherwise(F.col(column))).drop("_flag", "_run")


def movement_ranges(df: DataFrame, level: str, still: float, window: int, bridge: int, lead: int, most: int, least: int, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Ranges of movement for a placement test: ``start, end`` per session.

    A sample is still if any ``window`` samples in a row around it stay at or under ``still``.
    Moving runs under ``bridge`` samples between still ones are still, and so is a first run of 2 to
    ``bridge``.  Runs start ``lead`` samples early, end after ``most`` samples at the latest,
    and count if they are longer than ``least``.
    """
    w = by_seq(key, seq)
    ahead = w.rowsBetween(0, window - 1)
    begins = (F.max(level).over(ahead) <= still) & (F.count(F.lit(1)).over(ahead) == window)
    marked = df.withColumn("_begins", begins.cast("int"))
    marked = marked.withColumn("_still", F.max("_begins").over(w.rowsBetween(1 - window, 0)))
    runs = with_runs(marked, F.col("_still") == 0, key, seq)
    n = F.max(seq).over(Window.partitionBy(key)) + 1
    run = Window.partitionBy(key, "_run")
    a, b = F.min(seq).over(run), F.max(seq).over(run) + 1
    short = (b < n) & F.when(a > 0, b - a < bridge).otherwise((b > 1) & (b <= bridge))
    moving = runs.withColumn("_moving", F.col("_flag") & ~short).drop("_flag", "_run")
    found = ranges(moving, F.col("_moving"), "drop_last", key, seq).withColumn("start", F.col("start") - lead)
    return found.withColumn("end", F.least(F.col("end"), F.col("start") + most)).where(F.col("end") - F.col("start") > least).select(key, "start", "end")


def tile_activity(df: DataFrame, columns: list[str], window: int, far: float, share: float, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """``tile`` and, for each column, whether it is active there: more than ``share`` of the whole
    tile's samples lie further than ``far`` from the tile's mean.  The last whole or broken tile is left out.

    Means are summed in the order of the samples, so a sample that lies ``far`` away but for
    the last bit is judged alike however the rows were shuffled.
    """
    n = F.max(seq).over(Window.partitionBy(key)) + 1
    tile = Window.partitionBy(key, "_tile").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tiled = df.withColumn("_tile", F.floor(F.col(seq) / window)).withColumn("_n", n).where(F.col("_tile") * window < F.col("_n") - window)
    moved = tiled.select(key, "_tile", *(F.when(F.abs(F.col(c) - F.avg(c).over(tile)) > far, 1).otherwise(0).alias(c) for c in columns))
    return moved.groupBy(key, F.col("_tile").alias("tile")).agg(*((F.sum(c) > share * window).cast("int").alias(c) for c in columns))


def missing_tiles(tiles: DataFrame, hip: str, feet: list[str], key: str = KEY) -> DataFrame:
    """Tiles in a row, up to each, in which a sensor was missing while another moved.

    ``hip_alone``: tiles with a moving foot and a still hip since the hip last moved; ``<sensor>_still``:
    still tiles in a row.  A session is cut where the hip's counts pass their bounds.
    """
    w = Window.partitionBy(key).orderBy("tile")
    foot = F.greatest(*(F.col(c) for c in feet))
    reset = F.sum(hip).over(w)
    alone = F.when((foot == 1) & (F.col(hip) == 0), 1).otherwise(0)
    out = tiles.withColumn("_since", reset)
    out = out.withColumn("hip_alone", F.sum(alone).over(Window.partitionBy(key, "_since").orderBy("tile")).cast("int")).drop("_since")
    for c in (hip, *feet):
        out = out.withColumn("_since", F.sum(c).over(w))
        out = out.withColumn(f"{c}_still", F.sum(1 - F.col(c)).over(Window.partitionBy(key, "_since").orderBy("tile")).cast("int")).drop("_since")
    return out
