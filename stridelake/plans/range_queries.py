"""Ranges, gap filling and sessionization over the samples view."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.operators import guards as G
from stridelake.operators import ranges as R
from stridelake.operators.phases import standing
from stridelake.plans.register import S, query, samples

RUNS = S + """, c AS (SELECT *, CASE WHEN {flag} = lag({flag}) OVER w THEN 0 ELSE 1 END AS ch, {flag} AS f FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM c),
g AS (SELECT session_id, run, min(seq) AS a, max(seq) + 1 AS b, any_value(n) AS n FROM r WHERE f GROUP BY session_id, run)"""
EXACT = "SELECT session_id, a AS start, b AS \"end\", b - a AS length FROM g"
CLOSED = "SELECT * FROM (SELECT session_id, a AS start, CASE WHEN b = n THEN n - 1 ELSE b END AS \"end\", CASE WHEN b = n THEN n - 1 ELSE b END - a AS length FROM g) WHERE length > 0"


@query(RUNS.format(flag="(phase = 0)") + CLOSED)
def value_ranges(spark, sf_dir):
    """Ranges of a value, with the closing-edge rule."""
    return R.ranges(samples(spark, sf_dir), F.col("phase") == 0, "drop_last")


@query(RUNS.format(flag="(phase = 0)") + EXACT)
def exact_runs(spark, sf_dir):
    """Exact runs."""
    return R.ranges(samples(spark, sf_dir), F.col("phase") == 0)


def _fill_sql(source: str, k: int, value: int, new: int, out: str) -> str:
    return f""", {out}c AS (SELECT *, CASE WHEN (x = {value}) = lag(x = {value}) OVER (PARTITION BY session_id ORDER BY seq) THEN 0 ELSE 1 END AS ch FROM {source}),
{out}r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM {out}c),
{out}e AS (SELECT *, min(seq) OVER (PARTITION BY session_id, run) AS a, max(seq) OVER (PARTITION BY session_id, run) + 1 AS b0 FROM {out}r),
{out} AS (SELECT session_id, seq, CASE WHEN x = {value} AND seq < CASE WHEN b0 = n THEN n - 1 ELSE b0 END AND CASE WHEN b0 = n THEN n - 1 ELSE b0 END - a < {k} THEN {new} ELSE x END AS x FROM {out}e)"""


@query(S + ", x0 AS (SELECT session_id, seq, active AS x FROM s)" + _fill_sql("x0", 2, 0, 1, "f1") + _fill_sql("f1", 4, 1, 0, "f2") + "SELECT session_id, seq, x AS active FROM f2")
def bridge_then_drop(spark, sf_dir):
    """Bridge short gaps, then drop short activity."""
    bridged = R.fill_short_runs(samples(spark, sf_dir).select("session_id", "seq", "active"), "active", 0, 2, 1)
    return R.fill_short_runs(bridged, "active", 1, 4, 0)


GAP = 36_000_000_000


@query(S + f""", b AS (SELECT *, sum(nw) OVER (PARTITION BY session_id ORDER BY seq) AS block FROM (SELECT *, CASE WHEN micros - lag(micros) OVER (PARTITION BY session_id ORDER BY seq) > {GAP} THEN 1 ELSE 0 END AS nw FROM s WHERE active = 1))
SELECT session_id, CAST(block AS BIGINT) AS block, min(micros) AS start_micros, max(micros) AS end_micros, count(*) AS n, round(sum(signal), 6) AS total, round(avg(signal), 6) AS mean FROM b GROUP BY session_id, block""")
def active_blocks(spark, sf_dir):
    """Sessionize activity by gaps of more than ten hours, with each block's measures."""
    blocks = R.sessionize(samples(spark, sf_dir).where("active = 1"), "micros", GAP)
    return blocks.groupBy("session_id", "block").agg(
        F.min("micros").alias("start_micros"), F.max("micros").alias("end_micros"), F.count("*").alias("n"), F.round(F.sum("signal"), 6).alias("total"), F.round(F.avg("signal"), 6).alias("mean")
    )


@query(RUNS.format(flag="(active = 1)") + """, m AS (SELECT *, sum(nw) OVER (PARTITION BY session_id ORDER BY a) AS block FROM (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY session_id ORDER BY a) >= 2 THEN 1 ELSE 0 END AS nw FROM g))
SELECT session_id, CAST(block AS BIGINT) AS block, min(a) AS start, max(b) AS "end", count(*) AS n_ranges FROM m GROUP BY session_id, block""")
def merged_blocks_strict(spark, sf_dir):
    """Ranges merged while their gap stays under a bound."""
    return R.merge_ranges(R.ranges(samples(spark, sf_dir), F.col("active") == 1), 2, strict=True)


@query(S + """, u AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY session_id ORDER BY seq) AS BIGINT) AS unit FROM (SELECT *, CASE WHEN phase <> lag(phase) OVER (PARTITION BY session_id ORDER BY seq) THEN 1 ELSE 0 END AS nw FROM s))
SELECT session_id, unit, any_value(phase) AS phase, min(seq) AS start, max(seq) + 1 AS "end" FROM u WHERE phase <> 0 GROUP BY session_id, unit""")
def unit_blocks(spark, sf_dir):
    """Unit blocks cut where the zone changes; zone 0 opens none."""
    cut = R.cut_at_changes(samples(spark, sf_dir), "phase").where("phase <> 0")
    return cut.groupBy("session_id", "unit").agg(F.min("phase").alias("phase"), F.min("seq").alias("start"), (F.max("seq") + 1).alias("end"))


@query(RUNS.format(flag="(phase >= 2 OR active = 0)") + "SELECT session_id, a AS start, CASE WHEN b = n THEN n - 1 ELSE b END AS \"end\", (CASE WHEN b = n THEN n - 1 ELSE b END - a) * 10 AS duration_ms FROM g WHERE CASE WHEN b = n THEN n - 1 ELSE b END - a BETWEEN 2 AND 15")
def contact_steps(spark, sf_dir):
    """Contact ranges of a length in bounds, 10 ms a sample."""
    found = R.ranges(samples(spark, sf_dir), (F.col("phase") >= 2) | (F.col("active") == 0), "drop_last").where("length BETWEEN 2 AND 15")
    return found.select("session_id", "start", "end", (F.col("length") * 10).alias("duration_ms"))


@query(RUNS.format(flag="(phase >= 2)") + """, p AS (SELECT session_id, seq AS lo, lead(seq) OVER (PARTITION BY session_id ORDER BY seq) AS hi FROM s WHERE event_type = 'signup'),
k AS (SELECT session_id, a, CASE WHEN b = n THEN n - 1 ELSE b END AS b FROM g),
i AS (SELECT p.session_id, lo, hi FROM p JOIN k ON k.session_id = p.session_id AND a > lo AND b < hi WHERE b > a GROUP BY p.session_id, lo, hi HAVING count(*) > 1),
x0 AS (SELECT s.session_id, s.seq, CASE WHEN EXISTS (SELECT 1 FROM i WHERE i.session_id = s.session_id AND s.seq >= i.lo AND s.seq < i.hi) THEN 1 ELSE 0 END AS x FROM s)""" + _fill_sql("x0", 6, 0, 1, "f1") + "SELECT session_id, seq, x AS remove FROM f1")
def removal_flag(spark, sf_dir):
    """Samples between correction points that hold too many steps are flagged, short gaps bridged."""
    s = samples(spark, sf_dir)
    found = R.ranges(s, F.col("phase") >= 2, "drop_last")
    dense = R.between_points(found, s.where("event_type = 'signup'").select("session_id", "seq"), 1)
    return R.flag_intervals(s.select("session_id", "seq"), dense, 6)


EXACT_END = ("CASE WHEN b0 = n THEN n - 1 ELSE b0 END", "b0")


@query(S + ", x0 AS (SELECT session_id, seq, CAST(signal BETWEEN 20 AND 200 AS INTEGER) AS x FROM s)" + _fill_sql("x0", 4, 1, 0, "f1").replace(*EXACT_END) + _fill_sql("f1", 3, 0, 1, "f2").replace(*EXACT_END) + "SELECT session_id, seq, x AS standing FROM f2")
def standing_runs(spark, sf_dir):
    """Pitch inside a band in runs of over three samples, gaps under three filled."""
    return standing(samples(spark, sf_dir).select("session_id", "seq", "signal"), "signal", 20, 200, 3, 3).select("session_id", "seq", "standing")


@query(S + ", x0 AS (SELECT session_id, seq, 1 - active AS x FROM s)" + _fill_sql("x0", 2, 1, 0, "f1").replace("CASE WHEN b0 = n THEN n - 1 ELSE b0 END", "b0") + """, c2 AS (SELECT *, CASE WHEN x = lag(x) OVER (PARTITION BY session_id ORDER BY seq) THEN 0 ELSE 1 END AS ch FROM f1),
r2 AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run FROM c2)
SELECT session_id, min(seq) AS start, max(seq) + 1 AS "end" FROM r2 WHERE x = 0 GROUP BY session_id, run HAVING count(*) >= 8""")
def long_dynamic(spark, sf_dir):
    """Short static runs become dynamic, then long dynamic runs are kept."""
    static = samples(spark, sf_dir).select("session_id", "seq", (1 - F.col("active")).alias("x"))
    filled = R.fill_short_runs(static, "x", 1, 2, 0, closed_end="exact")
    return R.ranges(filled, F.col("x") == 0).where("length >= 8").select("session_id", "start", "end")


@query(S + """, m AS (SELECT session_id, seq, max(signal) OVER f <= 60 AND count(*) OVER f = 3 AS begins FROM s WINDOW f AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
t AS (SELECT session_id, seq, max(CAST(begins AS INTEGER)) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS still FROM m),
c1 AS (SELECT *, CASE WHEN still = lag(still) OVER (PARTITION BY session_id ORDER BY seq) THEN 0 ELSE 1 END AS ch FROM t),
r1 AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM c1),
e1 AS (SELECT *, min(seq) OVER (PARTITION BY session_id, run) AS a, max(seq) OVER (PARTITION BY session_id, run) + 1 AS b FROM r1),
v AS (SELECT session_id, seq, n, still = 0 AND NOT (b < n AND CASE WHEN a > 0 THEN b - a < 3 ELSE b BETWEEN 2 AND 3 END) AS moving FROM e1),
c2 AS (SELECT *, CASE WHEN moving = lag(moving) OVER (PARTITION BY session_id ORDER BY seq) THEN 0 ELSE 1 END AS ch FROM v),
r2 AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run FROM c2),
g AS (SELECT session_id, min(seq) - 2 AS a, max(seq) + 1 AS b, any_value(n) AS n, min(seq) AS first FROM r2 WHERE moving GROUP BY session_id, run),
k AS (SELECT session_id, a, least(CASE WHEN b = n THEN n - 1 ELSE b END, a + 12) AS b FROM g WHERE first < CASE WHEN b = n THEN n - 1 ELSE b END)
SELECT session_id, a AS start, b AS "end" FROM k WHERE b - a > 5""")
def movement_windows(spark, sf_dir):
    """Ranges of movement, found by still windows, with filled gaps, lead and bounds on the length."""
    return R.movement_ranges(samples(spark, sf_dir).select("session_id", "seq", "signal"), "signal", 60, 3, 3, 2, 12, 5)


TILES = """, z AS (SELECT session_id, seq, seq // 4 AS tile, max(seq) OVER (PARTITION BY session_id) + 1 AS n, signal AS hip, CASE WHEN phase = 2 THEN signal ELSE 0 END AS lf, CASE WHEN phase = 1 THEN signal ELSE 0 END AS rf FROM s),
y AS (SELECT session_id, tile, """ + ", ".join(f"CASE WHEN abs({c} - avg({c}) OVER (PARTITION BY session_id, tile)) > 20 THEN 1 ELSE 0 END AS {c}" for c in ("hip", "lf", "rf")) + """ FROM z WHERE tile * 4 < n - 4),
a AS (SELECT session_id, tile, """ + ", ".join(f"CAST(sum({c}) > 0.3 * 4 AS INTEGER) AS {c}" for c in ("hip", "lf", "rf")) + """ FROM y GROUP BY session_id, tile),
q AS (SELECT *, """ + ", ".join(f"sum({c}) OVER (PARTITION BY session_id ORDER BY tile) AS {c}_k" for c in ("hip", "lf", "rf")) + """ FROM a)
SELECT session_id, tile, hip, lf, rf, CAST(sum(CASE WHEN greatest(lf, rf) = 1 AND hip = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, hip_k ORDER BY tile) AS INTEGER) AS hip_alone, """ + ", ".join(f"CAST(sum(1 - {c}) OVER (PARTITION BY session_id, {c}_k ORDER BY tile) AS INTEGER) AS {c}_still" for c in ("hip", "lf", "rf")) + " FROM q"


@query(S + TILES)
def tile_activity(spark, sf_dir):
    """Activity of fixed tiles by the share of samples far from the tile's mean, and how long sensors were missing."""
    s = samples(spark, sf_dir)
    part = lambda k: F.when(F.col("phase") == k, F.col("signal")).otherwise(0.0)
    sensors = s.select("session_id", "seq", F.col("signal").alias("hip"), part(2).alias("lf"), part(1).alias("rf"))
    return R.missing_tiles(R.tile_activity(sensors, ["hip", "lf", "rf"], 4, 20, 0.3), "hip", ["lf", "rf"])


@query(S + """, c AS (SELECT *, CASE WHEN phase = 2 AND coalesce(lag(phase) OVER (PARTITION BY session_id ORDER BY seq), -1) <> 2 THEN 1 ELSE 0 END AS nw FROM s)
SELECT session_id, seq, CASE WHEN phase = 2 THEN CAST(sum(nw) OVER (PARTITION BY session_id ORDER BY seq) AS DOUBLE) END AS impact_interval FROM c""")
def phase_intervals(spark, sf_dir):
    """Number of the impact interval a sample lies in, else null."""
    w = R.by_seq()
    new = F.when((F.col("phase") == 2) & (F.coalesce(F.lag("phase").over(w), F.lit(-1)) != 2), 1).otherwise(0)
    return samples(spark, sf_dir).withColumn("_new", new).select("session_id", "seq", F.when(F.col("phase") == 2, F.sum("_new").over(w).cast("double")).alias("impact_interval"))


@query(S + """, h AS (SELECT *, abs(signal - lag(signal, 6) OVER (PARTITION BY session_id ORDER BY seq)) > 150 AS turn FROM s)
SELECT session_id, seq, CAST(coalesce(max(CAST(turn AS INTEGER)) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING), 0) AS INTEGER) AS change_of_direction FROM h""")
def change_of_direction(spark, sf_dir):
    """A large lag-6 difference marks six samples on either side."""
    w = R.by_seq()
    turned = samples(spark, sf_dir).withColumn("turn", (F.abs(F.col("signal") - F.lag("signal", 6).over(w)) > 150).cast("int"))
    return turned.select("session_id", "seq", F.coalesce(F.max("turn").over(w.rowsBetween(-6, 6)), F.lit(0)).alias("change_of_direction"))


@query(S + """, u AS (SELECT session_id, 'hip' AS sensor, seq, signal AS x FROM s UNION ALL SELECT session_id, 'lf', seq, signal * (phase + 1) / 2 FROM s),
m AS (SELECT *, avg(CASE WHEN seq <= 10 THEN x END) OVER (PARTITION BY session_id, sensor) AS base, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM u),
f AS (SELECT *, x - base >= 30 AS f FROM m), c AS (SELECT *, CASE WHEN f = lag(f) OVER w THEN 0 ELSE 1 END AS ch FROM f WINDOW w AS (PARTITION BY session_id, sensor ORDER BY seq)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id, sensor ORDER BY seq) AS run FROM c),
g AS (SELECT session_id, sensor, run, min(seq) AS a, max(seq) + 1 AS b, any_value(n) AS n FROM r WHERE f GROUP BY session_id, sensor, run),
k AS (SELECT session_id, sensor, count(*) AS n_runs FROM g WHERE CASE WHEN b = n THEN n - 1 ELSE b END - a > 1 GROUP BY session_id, sensor)
SELECT session_id, max(n_runs) AS n_runs, max(n_runs) > 1 AS alert FROM k GROUP BY session_id""")
def quality_flag(spark, sf_dir):
    """Long runs over a sensor's level at the start; a session with many in one sensor raises an alert."""
    s = samples(spark, sf_dir)
    sensors = s.select("session_id", "seq", F.explode(F.array(F.struct(F.lit("hip").alias("sensor"), F.col("signal").alias("x")), F.struct(F.lit("lf").alias("sensor"), (F.col("signal") * (F.col("phase") + 1) / 2).alias("x")))).alias("v"))
    return G.quality_alerts(sensors.select("session_id", "seq", "v.*"), first=11, level=30, longer=1, more=1)


@query(S + ", x0 AS (SELECT session_id, seq, CAST(signal >= 20 AS INTEGER) AS x FROM s)" + _fill_sql("x0", 2, 0, 1, "f1") + _fill_sql("f1", 3, 1, 0, "f2") + """, j AS (SELECT f2.*, s.signal FROM f2 JOIN s ON f2.session_id = s.session_id AND f2.seq = s.seq),
c3 AS (SELECT *, CASE WHEN x = lag(x) OVER (PARTITION BY session_id ORDER BY seq) THEN 0 ELSE 1 END AS ch FROM j),
r3 AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM c3),
e3 AS (SELECT *, min(seq) OVER (PARTITION BY session_id, run) AS a, max(seq) OVER (PARTITION BY session_id, run) + 1 AS b0 FROM r3),
h3 AS (SELECT *, CASE WHEN b0 = n THEN n - 1 ELSE b0 END AS b FROM e3),
p3 AS (SELECT *, avg(CASE WHEN seq < b THEN CASE WHEN signal >= 60 THEN 1.0 ELSE 0.0 END END) OVER (PARTITION BY session_id, run) AS part FROM h3)
SELECT session_id, seq, CASE WHEN x = 1 AND seq < b AND b - a > 4 AND part < 0.3 THEN 0 ELSE x END AS active FROM p3""")
def one_sensor_activity(spark, sf_dir):
    """Activity of one sensor: bridge, drop short runs, then long runs without strong samples."""
    s = samples(spark, sf_dir).select("session_id", "seq", "signal", (F.col("signal") >= 20).cast("int").alias("active"))
    kept = R.fill_short_runs(R.fill_short_runs(s, "active", 0, 2, 1), "active", 1, 3, 0)
    return R.drop_quiet_runs(kept, "active", 4, F.col("signal") >= 60, 0.3).select("session_id", "seq", "active")
