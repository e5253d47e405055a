"""Window functions over the samples view."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.operators import windows as V
from stridelake.operators.ranges import by_seq
from stridelake.plans.register import S, query, samples

W = "WINDOW w AS (PARTITION BY session_id ORDER BY seq)"


@query(S + f" SELECT session_id, seq, round(coalesce(signal - lag(signal) OVER w, 0), 6) AS diff FROM s {W}")
def first_diff(spark, sf_dir):
    """V1."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.first_diff("signal", 0.0), 6).alias("diff"))


@query(S + f", d AS (SELECT *, coalesce(signal - lag(signal) OVER w, 0) AS x FROM s {W}) SELECT session_id, seq, round(CASE WHEN abs(x) > 30 THEN 0 ELSE x END, 6) AS diff FROM d")
def diff_outlier_reset(spark, sf_dir):
    """V2."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.reset_outlier(V.first_diff("signal", 0.0), 30.0), 6).alias("diff"))


def _std_sql(before: int, after: int, least: int) -> str:
    frame = f"(PARTITION BY session_id ORDER BY seq ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"
    return S + f" SELECT session_id, seq, round(CASE WHEN count(signal) OVER {frame} >= {least} THEN stddev_samp(signal) OVER {frame} END, 6) AS std FROM s"


@query(_std_sql(50, 49, 100))
def rolling_std_100(spark, sf_dir):
    """V3: a full centred window of 100."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.rolling_std("signal", 50, 49, 100), 6).alias("std"))


@query(_std_sql(6, 6, 5))
def rolling_std_13(spark, sf_dir):
    """V4: a centred window of 13 with at least 5 values."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.rolling_std("signal", 6, 6, 5), 6).alias("std"))


@query(S + f" SELECT session_id, seq, round(CASE WHEN lag(signal) OVER w IS NULL OR lead(signal) OVER w IS NULL THEN signal ELSE (lag(signal) OVER w + signal + lead(signal) OVER w) / 3 END, 6) AS mean3 FROM s {W}")
def rolling_mean3_edges(spark, sf_dir):
    """V5."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.mean3_edges("signal"), 6).alias("mean3"))


@query(S + " SELECT session_id, seq, round(sum(signal) OVER (PARTITION BY session_id ORDER BY seq) / sum(signal) OVER (PARTITION BY session_id), 6) AS share FROM s")
def cumulative_share(spark, sf_dir):
    """V6."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.cumulative_share("signal"), 6).alias("share"))


@query(S + " SELECT session_id, phase, seq, round(sum(signal) OVER (PARTITION BY session_id, phase ORDER BY seq), 6) AS running, row_number() OVER (PARTITION BY session_id, phase ORDER BY seq) AS position FROM s")
def running_total_by_side(spark, sf_dir):
    """Running totals and positions within a side."""
    w = Window.partitionBy("session_id", "phase").orderBy("seq")
    return samples(spark, sf_dir).select("session_id", "phase", "seq", F.round(F.sum("signal").over(w), 6).alias("running"), F.row_number().over(w).cast("long").alias("position"))


@query(S + """, k AS (SELECT *, sum(CAST(signal < 100 AS INTEGER)) OVER f AS still, count(*) OVER f AS n FROM s WINDOW f AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN 24 PRECEDING AND CURRENT ROW))
SELECT session_id, max(seq) - 24 AS start FROM k WHERE n = 25 AND still >= 20 GROUP BY session_id""")
def last_static_window(spark, sf_dir):
    """The last of the windows of 25 samples that are still enough."""
    return V.last_static_window(samples(spark, sf_dir), F.col("signal") < 100, 25, 20)


@query(S + " SELECT session_id, seq, (micros - min(micros) OVER (PARTITION BY session_id)) / 1e6 AS elapsed FROM s")
def elapsed_seconds(spark, sf_dir):
    """V11, D4."""
    return samples(spark, sf_dir).select("session_id", "seq", ((F.col("micros") - F.min("micros").over(Window.partitionBy("session_id"))) / 1e6).alias("elapsed"))


@query(S + ", q AS (SELECT session_id, seq, floor(signal / 10) AS v FROM s) SELECT session_id, seq, rank() OVER (PARTITION BY session_id ORDER BY v) + (count(*) OVER (PARTITION BY session_id, v) - 1) / 2.0 AS rank FROM q")
def average_ranks(spark, sf_dir):
    """Ranks with mean ties."""
    q = samples(spark, sf_dir).select("session_id", "seq", F.floor(F.col("signal") / 10).alias("v"))
    return q.select("session_id", "seq", V.average_rank("v", "session_id").alias("rank"))


@query(S + ", q AS (SELECT session_id, seq, CASE WHEN phase <> 1 THEN signal END AS x FROM s) SELECT session_id, seq, last_value(x IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY seq) AS filled FROM q")
def forward_fill(spark, sf_dir):
    """Missing values take the value before; none before the first."""
    q = samples(spark, sf_dir).select("session_id", "seq", F.when(F.col("phase") != 1, F.col("signal")).alias("x"))
    return q.select("session_id", "seq", V.forward_fill("x").alias("filled"))


@query(S + f", k AS (SELECT *, coalesce(signal > lag(signal) OVER w AND signal >= lead(signal) OVER w AND signal >= 50, false) AS peak FROM s {W}) SELECT session_id, seq, signal FROM k WHERE peak")
def local_peaks(spark, sf_dir):
    """F4 without a distance."""
    return samples(spark, sf_dir).withColumn("peak", V.local_peaks("signal", 50.0)).where("peak").select("session_id", "seq", "signal")


FRAME13 = "(PARTITION BY session_id ORDER BY seq ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)"


@query(S + f" SELECT session_id, seq, round(100 * (1 - least(greatest(CASE WHEN count(signal) OVER {FRAME13} >= 5 THEN stddev_samp(signal) OVER {FRAME13} END, 0), 100) / 100.0), 6) AS score FROM s")
def control_score(spark, sf_dir):
    """control from the spread of 13 samples."""
    return samples(spark, sf_dir).select("session_id", "seq", F.round(V.control_score("signal", 100.0), 6).alias("score"))


@query(S + """, q AS (SELECT session_id, seq, micros, CASE WHEN phase <> 0 THEN signal END AS x FROM s),
e AS (SELECT *, last_value(x IGNORE NULLS) OVER a AS y0, last_value(CASE WHEN x IS NOT NULL THEN micros END IGNORE NULLS) OVER a AS x0, first_value(x IGNORE NULLS) OVER b AS y1, first_value(CASE WHEN x IS NOT NULL THEN micros END IGNORE NULLS) OVER b AS x1
  FROM q WINDOW a AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT session_id, seq, round(coalesce(CASE WHEN x1 = x0 THEN y0 ELSE y0 + (y1 - y0) * CAST(micros - x0 AS DOUBLE) / CAST(x1 - x0 AS DOUBLE) END, y0, y1), 5) AS value FROM e""")
def interpolated(spark, sf_dir):
    """A sparse series on the full grid."""
    q = samples(spark, sf_dir).select("session_id", "seq", "micros", F.when(F.col("phase") != 0, F.col("signal")).alias("x"))
    return q.select("session_id", "seq", F.round(V.interpolate("x", "micros"), 5).alias("value"))


@query(S + """, d AS (SELECT *, signal - lag(signal) OVER w AS d, CASE WHEN (phase >= 2) = lag(phase >= 2) OVER w THEN 0 ELSE 1 END AS ch FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run FROM d),
e AS (SELECT session_id, run, count(*) AS n, min(seq) AS start, max(signal) - min(signal) AS spread, sum(CASE WHEN ch = 0 THEN abs(d) ELSE 0 END) AS a, sum(CASE WHEN ch = 0 AND d > 0 THEN d ELSE 0 END) AS p, sum(CASE WHEN ch = 0 AND d < 0 THEN d ELSE 0 END) AS m FROM r WHERE phase >= 2 GROUP BY session_id, run)
SELECT session_id, start, round(a / (n * 0.01), 4) AS abs_rate, round(p / (n * 0.01), 4) AS pos_rate, round(m / (n * 0.01), 4) AS neg_rate, round(spread / (n * 0.01), 4) AS range_rate FROM e WHERE n > 1""")
def motion_covered(spark, sf_dir):
    """motion covered in each contact run, per second at 10 ms a sample."""
    from stridelake.operators.ranges import with_runs

    w = by_seq()
    s = samples(spark, sf_dir).withColumn("d", F.col("signal") - F.lag("signal").over(w))
    runs = with_runs(s, F.col("phase") >= 2).where("_flag")
    inner = F.col("seq") > F.min("seq").over(Window.partitionBy("session_id", "_run"))
    d = F.when(F.col("inner"), F.col("d")).otherwise(0.0)
    found = runs.withColumn("inner", inner).groupBy("session_id", "_run").agg(
        F.count("*").alias("n"), F.min("seq").alias("start"), (F.max("signal") - F.min("signal")).alias("spread"), F.sum(F.abs(d)).alias("a"), F.sum(F.greatest(d, F.lit(0.0))).alias("p"), F.sum(F.least(d, F.lit(0.0))).alias("m")
    ).where("n > 1")
    rate = lambda c, out: F.round(F.col(c) / (F.col("n") * 0.01), 4).alias(out)
    return found.select("session_id", "start", rate("a", "abs_rate"), rate("p", "pos_rate"), rate("m", "neg_rate"), rate("spread", "range_rate"))
