"""Joins over the samples, steps and blocks views."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.operators import joins as J
from stridelake.operators import ranges as R
from stridelake.plans.register import S, T, query, samples, steps, table

HALF_HOUR = 1_800_000_000
ISLANDS = """, {n}c AS (SELECT *, CASE WHEN (phase = {v}) = lag(phase = {v}) OVER (PARTITION BY session_id ORDER BY seq) THEN 0 ELSE 1 END AS ch FROM s),
{n}r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run FROM {n}c),
{n} AS (SELECT session_id, min(seq) AS a, max(seq) + 1 AS b FROM {n}r WHERE phase = {v} GROUP BY session_id, run)"""


@query(S + f"""SELECT l.session_id, l.event_id AS left_id, r.event_id AS right_id, CAST((r.micros - l.micros) AS DOUBLE) / 1000 AS diff_ms, CASE WHEN l.micros < r.micros THEN 'left' WHEN l.micros > r.micros THEN 'right' ELSE 'both' END AS first
FROM s l JOIN s r ON l.session_id = r.session_id AND abs(l.micros - r.micros) <= {HALF_HOUR} WHERE l.event_type = 'click' AND r.event_type = 'purchase'""")
def impact_pairs(spark, sf_dir):
    """Pairs of impacts within a band, with the signed difference and the first foot."""
    s = samples(spark, sf_dir)
    side = lambda kind, p: s.where(F.col("event_type") == kind).select("session_id", F.col("event_id").alias(f"{p}_id"), F.col("micros").alias(f"{p}_at"))
    met = J.band_join(side("click", "left"), side("purchase", "right"), ["session_id"], "left_at", "right_at", HALF_HOUR)
    first = F.when(F.col("left_at") < F.col("right_at"), "left").when(F.col("left_at") > F.col("right_at"), "right").otherwise("both")
    return met.select("session_id", "left_id", "right_id", ((F.col("right_at") - F.col("left_at")) / 1000).alias("diff_ms"), first.alias("first"))


@query(S + ISLANDS.format(n="l", v=2) + ISLANDS.format(n="q", v=3) + """
SELECT l.session_id, l.a AS l_start, l.b AS l_end, q.a AS r_start, q.b AS r_end FROM l JOIN q ON l.session_id = q.session_id AND l.a - 3 < q.b + 3 AND q.a - 3 < l.b + 3""")
def overlap_marks(spark, sf_dir):
    """Impact and takeoff runs that overlap when padded by three samples."""
    s = samples(spark, sf_dir)
    one = lambda v, p: R.ranges(s, F.col("phase") == v).select("session_id", F.col("start").alias(f"{p}_start"), F.col("end").alias(f"{p}_end"))
    return J.overlap_join(one(2, "l"), one(3, "r"), ["session_id"], 3, 16)


@query(S + """SELECT session_id, seq FROM s p WHERE event_type = 'signup' AND EXISTS (SELECT 1 FROM s t WHERE t.session_id = p.session_id AND t.event_type = 'error' AND t.seq BETWEEN p.seq - 8 AND p.seq + 4)""")
def padded_semi_join(spark, sf_dir):
    """Correction points near a trough."""
    s = samples(spark, sf_dir)
    return J.near_points(s.where("event_type = 'signup'").select("session_id", "seq"), s.where("event_type = 'error'").select("session_id", "seq"), ["session_id"], "seq", "seq", 8, 4)


@query(S + " SELECT session_id, seq FROM s WHERE (session_id, seq) NOT IN (SELECT session_id, seq FROM s WHERE phase = 1)")
def rows_not_in(spark, sf_dir):
    """J6."""
    s = samples(spark, sf_dir).select("session_id", "seq", "phase")
    return s.join(s.where("phase = 1").select("session_id", "seq"), ["session_id", "seq"], "left_anti").select("session_id", "seq")


@query("""SELECT o_orderkey AS block_id, c_name AS user_name, coalesce(c_acctbal, 70) AS mass, n_name AS region, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END, '2.0') AS version
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def enriched_blocks(spark, sf_dir):
    """Metadata put to every row, with defaults."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    version = F.coalesce(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")), F.lit("2.0"))
    return joined.select(F.col("o_orderkey").alias("block_id"), F.col("c_name").alias("user_name"), F.coalesce("c_acctbal", F.lit(70.0)).alias("mass"), F.col("n_name").alias("region"), version.alias("version"))


@query(T + """, l AS (SELECT block_id, count(*) AS n FROM t WHERE side = 'LF' GROUP BY block_id), r AS (SELECT block_id, count(*) AS n FROM t WHERE side = 'RF' GROUP BY block_id)
SELECT coalesce(l.block_id, r.block_id) AS block_id, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right FROM l FULL OUTER JOIN r ON l.block_id = r.block_id""")
def both_sides(spark, sf_dir):
    """Blocks of either side; one grouping of the steps in place of a full join."""
    t = steps(spark, sf_dir).where("side IS NOT NULL")
    return t.groupBy("block_id").agg(F.count_if(F.col("side") == "LF").alias("n_left"), F.count_if(F.col("side") == "RF").alias("n_right"))


@query(S + """, v AS (SELECT session_id, seq, signal * 2 AS value FROM s WHERE phase = 2) SELECT s.session_id, s.seq, v.value FROM s LEFT JOIN v ON s.session_id = v.session_id AND s.seq = v.seq""")
def scattered_values(spark, sf_dir):
    """Values at their samples, null elsewhere."""
    s = samples(spark, sf_dir)
    return s.select("session_id", "seq").join(s.where("phase = 2").select("session_id", "seq", (F.col("signal") * 2).alias("value")), ["session_id", "seq"], "left")


@query(T + """, l AS (SELECT status, discount, sum(force) AS load FROM t WHERE side = 'LF' GROUP BY status, discount), r AS (SELECT status, discount, sum(force) AS movement FROM t WHERE side = 'RF' GROUP BY status, discount)
SELECT l.status, l.discount, load, movement FROM l JOIN r ON l.status = r.status AND l.discount = r.discount""")
def matched_groups(spark, sf_dir):
    """Loading and movement events with equal keys."""
    t = steps(spark, sf_dir)
    side = lambda k, out: t.where(F.col("side") == k).groupBy("status", "discount").agg(F.sum("force").alias(out))
    return side("LF", "load").join(side("RF", "movement"), ["status", "discount"])


@query(S + ISLANDS.format(n="g", v=0) + """, m AS (SELECT g.session_id, a AS start, b AS "end", s.seq AS pos, s.signal AS pitch FROM g JOIN s ON g.session_id = s.session_id AND s.seq BETWEEN g.a AND g.b AND s.event_type IN ('click', 'view')),
p AS (SELECT *, row_number() OVER (PARTITION BY session_id, pos ORDER BY start) AS k FROM m), q AS (SELECT *, row_number() OVER (PARTITION BY session_id, start ORDER BY pos) AS j FROM p WHERE k = 1)
SELECT session_id, start, "end", pos AS "at", pitch FROM q WHERE j = 1""")
def interval_match(spark, sf_dir):
    """Points matched one to one with the ranges that hold them."""
    s = samples(spark, sf_dir)
    points = s.where("event_type IN ('click', 'view')").select("session_id", F.col("seq").alias("at"), F.col("signal").alias("pitch"))
    return J.interval_match(R.ranges(s, F.col("phase") == 0).drop("length"), points, ["session_id"], 16)
