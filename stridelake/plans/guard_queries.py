"""Guards, projections, stage tables and small rules, each with the SQL of the surveyed rule."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.functions import quaternion as Q
from stridelake.functions.lineage import new_folder
from stridelake.functions.metadata import TRANSITIONS
from stridelake.operators import calibrate, force, rates, signal
from stridelake.operators import guards as G
from stridelake.operators import joins as J
from stridelake.operators import placement as PL
from stridelake.operators import ranges as R
from stridelake.plans.geometry_queries import WXYZ, E, _columns, _out, _view
from stridelake.plans.range_queries import GAP
from stridelake.plans.register import S, T, query, samples, steps, table
from stridelake.sources import records


@query(S + " SELECT session_id, seq, signal AS acc_rf_x, phase AS acc_hip_x, active AS acc_lf_x, event_id AS static_rf FROM s")
def placed_columns(spark, sf_dir):
    """Sensor numbers in column names become sides by the placement [2, 1, 0]."""
    s = samples(spark, sf_dir).select("session_id", "seq", F.col("signal").alias("acc_0_x"), F.col("phase").alias("acc_1_x"), F.col("active").alias("acc_2_x"), F.col("event_id").alias("static_0"))
    return PL.rename_placed(s, [2, 1, 0])


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS DOUBLE) AS half, CAST(round_even(l_quantity / 4, 1) AS DOUBLE) AS quarter FROM lineitem")
def rounded_projection(spark, sf_dir):
    """A fixed projection, rounded half to even."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.bround(F.col("l_quantity") / 2, 0).alias("half"), F.bround(F.col("l_quantity") / 4, 1).alias("quarter"))


@query(S + """, d AS (SELECT session_id, CAST(floor(min(micros) / 3.6e9) * 3600000000 AS BIGINT) + session_id % 3 * 900000000 AS event_at FROM s GROUP BY session_id),
f AS (SELECT d.session_id, min(s.micros) AS first_at, any_value(event_at) AS event_at FROM d LEFT JOIN s ON s.session_id = d.session_id AND s.micros >= d.event_at GROUP BY d.session_id)
SELECT session_id, first_at, CASE WHEN first_at IS NULL OR first_at - event_at > 1200000000 THEN 'NO_DATA' END AS code FROM f""")
def start_guard(spark, sf_dir):
    """A session must start, after its date, within a bound (here twenty minutes)."""
    s = samples(spark, sf_dir)
    hour = F.floor(F.min("micros") / 3.6e9) * 3_600_000_000
    dates = s.groupBy("session_id").agg(hour.alias("_h")).select("session_id", (F.col("_h") + F.col("session_id") % 3 * 900_000_000).alias("event_at"))
    return G.start_guard(s, dates, "micros", 1.2e9)


@query(S + " SELECT session_id, count(*) AS n, CASE WHEN count(*) < 70 THEN 'TOO_SHORT' END AS code FROM s GROUP BY session_id")
def minimum_rows(spark, sf_dir):
    """Sessions under a least number of rows get a code."""
    return G.minimum_rows(samples(spark, sf_dir), 70)


@query(S + """, v AS (SELECT session_id, seq, event_id % 4 AS stance, active, phase AS lf, event_id * 7 % 4 AS rf, CASE WHEN phase <> 1 THEN signal END AS grf FROM s),
i AS (SELECT *, active = 1 AND stance <> 0 AS a FROM v), j AS (SELECT *, a AND stance NOT IN (0, 1) AS t, a AND lf IN (0, 2, 3) AS l, a AND rf IN (0, 2, 3) AS r FROM i)
SELECT session_id, seq, CAST(a AS INT) AS active, CAST(t AS INT) AS total_ind, CAST(l AS INT) AS lf_ind, CAST(r AS INT) AS rf_ind, grf * CAST(t AS INT) AS total_grf, grf * CAST(l AS INT) AS lf_grf, grf * CAST(r AS INT) AS rf_grf,
  grf * CAST(l AND NOT r AS INT) AS lf_only_grf, grf * CAST(NOT l AND r AS INT) AS rf_only_grf FROM j""")
def inactive_masking(spark, sf_dir):
    """P5: activity, contact indicators and masked forces."""
    s = samples(spark, sf_dir).select("session_id", "seq", (F.col("event_id") % 4).alias("stance"), "active", F.col("phase").alias("lf"), (F.col("event_id") * 7 % 4).alias("rf"), F.when(F.col("phase") != 1, F.col("signal")).alias("grf"))
    return G.mask_inactive(s, "stance", "active", "lf", "rf", "grf").drop("stance", "lf", "rf", "grf")


@query("""SELECT o_orderkey AS block_id, o_custkey AS session_id, epoch_us(o_orderdate) AS start_us, CAST(o_orderkey % 13 AS DOUBLE) AS cadence, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position
FROM orders WHERE o_orderkey % 13 NOT IN (0, 10) AND o_orderstatus <> 'P'""")
def walking_blocks(spark, sf_dir):
    """Unit blocks of a cadence (not 0, not 10, not missing), numbered by their start in each session."""
    cadence = F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 13).cast("double"))
    blocks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("block_id"), F.col("o_custkey").alias("session_id"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("start_us"), cadence.alias("cadence"))
    kept = blocks.where("cadence IS NOT NULL AND cadence NOT IN (0, 10)")
    return kept.withColumn("position", F.row_number().over(Window.partitionBy("session_id").orderBy("start_us", "block_id")).cast("long"))


@query("""WITH u AS (SELECT doc_id, text || CASE WHEN doc_id % 7 = 0 THEN '!!!!!' ELSE '' END AS body, CASE WHEN doc_id % 5 = 0 THEN 'http://x/' || doc_id WHEN doc_id % 5 < 3 THEN 's3://uploads-' || lang || '/' || doc_id END AS src FROM documents)
SELECT doc_id, CASE WHEN right(body, 5) = '!!!!!' THEN 'VOID_END' WHEN src IS NOT NULL AND NOT regexp_matches(src, '^s3://uploads-[a-zA-Z0-9-]+/.+$') THEN 'BAD_SOURCE' END AS code FROM u""")
def upload_checks(spark, sf_dir):
    """Void endings and bad source addresses of uploads."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.when(k % 7 == 0, "!!!!!").otherwise("")).alias("body"), F.when(k % 5 == 0, F.concat(F.lit("http://x/"), k)).when(k % 5 < 3, F.concat(F.lit("s3://uploads-"), "lang", F.lit("/"), k)).alias("src"))
    return d.select("doc_id", G.upload_code(F.col("body"), F.col("src"), "uploads-[a-zA-Z0-9-]+").alias("code"))


@query(T + """, a AS (SELECT block_id, list(accel ORDER BY step, accel) AS p FROM t GROUP BY block_id) SELECT block_id, len(p) AS n, list_position(p, list_max(p)) < list_position(p, list_min(p)) AS bad FROM a""")
def bad_steps(spark, sf_dir):
    """Steps whose highest pitch comes before the lowest."""
    a = steps(spark, sf_dir).groupBy("block_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "accel"))), lambda x: x["accel"]).alias("p"))
    return a.select("block_id", F.size("p").cast("long").alias("n"), G.bad_step(F.col("p")).alias("bad"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey = 2")
def csv_export_and_scan(spark, sf_dir):
    """A table exported as CSV with a header, and scanned with its schema."""
    folder = new_folder(spark, "stage")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    records.export_csv(n, folder)
    return records.scan_csv(spark, folder, n.schema).where("n_regionkey = 2")


@query("SELECT c_mktsegment AS session_id, c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def stage_tables(spark, sf_dir):
    """A stage written by session, one session deleted and others read by projection."""
    folder = new_folder(spark, "stage")
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("session_id"), "c_custkey", "c_acctbal", "c_name")
    records.write_stage(c, folder, rows_a_file=500)
    records.delete_stage(spark, folder, F.col("session_id") == "MACHINERY")
    assert records.read_stage(spark, folder, ["session_id"]).where("session_id = 'MACHINERY'").isEmpty()
    return records.read_stage(spark, folder, ["session_id", "c_custkey", "c_acctbal"], "BUILDING")


@query(S + """, b AS (SELECT session_id, list(seq ORDER BY seq) AS cuts FROM s WHERE event_type = 'signup' GROUP BY session_id),
c AS (SELECT s.session_id, seq, (SELECT count(*) FROM s p WHERE p.session_id = s.session_id AND p.event_type = 'signup' AND p.seq <= s.seq) AS chunk FROM s)
SELECT session_id, chunk, min(seq) AS start, max(seq) + 1 AS "end", count(*) AS n FROM c GROUP BY session_id, chunk""")
def boundary_chunks(spark, sf_dir):
    """A session cut at a list of boundaries."""
    s = samples(spark, sf_dir)
    cut = records.chunk_at(s.select("session_id", "seq"), s.where("event_type = 'signup'").select("session_id", "seq"))
    return cut.groupBy("session_id", "chunk").agg(F.min("seq").alias("start"), (F.max("seq") + 1).alias("end"), F.count("*").alias("n"))


@query("""WITH b AS (SELECT doc_id, strlen(text) AS n FROM documents), k AS (SELECT doc_id, n, unnest(range(0, greatest(n, 1), 3000)) AS start FROM b)
SELECT doc_id, CAST(start // 3000 AS INT) AS part, start, least(n - start, 3000) AS size FROM k""")
def byte_chunks(spark, sf_dir):
    """Uploads cut by a number of bytes."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    return records.chunk_by_bytes(d, "content", 3000).select("doc_id", "part", "start", F.octet_length("chunk").cast("long").alias("size"))


@query("SELECT conv_id, turn, text FROM conversations WHERE role = 'user' AND conv_id = (SELECT min(conv_id) FROM conversations)")
def document_scan(spark, sf_dir):
    """Documents of one session, projected; the filter reaches the scan."""
    c = table(spark, sf_dir, "conversations")
    first = c.agg(F.min("conv_id").alias("conv_id"))
    return c.where("role = 'user'").join(F.broadcast(first), "conv_id", "left_semi").select("conv_id", "turn", "text")


@query(E + ", h AS (SELECT *, vx AS w1, vy AS z1, sqrt(vx*vx+vy*vy) AS nh FROM e), k AS (SELECT *, w1/nh AS hw, z1/nh AS hz FROM h)" + """
SELECT vec_id, round(pw*(hw*hw+hz*hz), 6) + 0.0 AS w, round(px*(hw*hw-hz*hz)+2*hw*hz*py, 6) + 0.0 AS x, round(py*(hw*hw-hz*hz)-2*hw*hz*px, 6) + 0.0 AS y, round(pz*(hw*hw+hz*hz), 6) + 0.0 AS z FROM k""")
def heading_correction(spark, sf_dir):
    """Q12: an orientation turned by a heading, conj(h) q h."""
    p, _, v = _columns()
    n = F.sqrt(v[0] * v[0] + v[1] * v[1])
    h = (v[0] / n, F.lit(0.0), F.lit(0.0), v[1] / n)
    return _view(spark, sf_dir).select("vec_id", *_out(Q.correct_heading(p, h), WXYZ))


_YAW = " ".join(f"WHEN code = '{c}' THEN CASE WHEN foot = 'left' THEN {a} ELSE {b} END" for c, (a, b) in PL.YAW_FIXES.items())


@query(E + f""", c AS (SELECT *, CASE label WHEN 0 THEN 'ACE' WHEN 1 THEN 'ADE' WHEN 2 THEN 'BCF' WHEN 3 THEN 'BDF' ELSE 'XYZ' END AS code, CASE WHEN vec_id % 2 = 0 THEN 'left' ELSE 'right' END AS foot FROM e),
a AS (SELECT *, radians(CASE {_YAW} ELSE {PL.YAW_DEFAULT} END) / 2 AS h FROM c)
SELECT vec_id, round(pw*cos(h)+pz*sin(h), 6) + 0.0 AS w, round(px*cos(h)-py*sin(h), 6) + 0.0 AS x, round(py*cos(h)+px*sin(h), 6) + 0.0 AS y, round(pz*cos(h)-pw*sin(h), 6) + 0.0 AS z FROM a""")
def placement_yaw_fix(spark, sf_dir):
    """Q16: yaw fixed by the code of the placement and the foot."""
    p, _, _ = _columns()
    code = F.when(F.col("label") == 0, "ACE").when(F.col("label") == 1, "ADE").when(F.col("label") == 2, "BCF").when(F.col("label") == 3, "BDF").otherwise("XYZ")
    foot = F.when(F.col("vec_id") % 2 == 0, "left").otherwise("right")
    return _view(spark, sf_dir).select("vec_id", *_out(PL.fix_yaw(p, code, foot), WXYZ))


@query(S + """, c AS (SELECT session_id, seq, signal, lead(seq, 5) OVER (PARTITION BY session_id ORDER BY seq) AS stop, max(signal) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) - min(signal) OVER (PARTITION BY session_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS spread FROM s)
SELECT session_id, min(seq) AS start, arg_min(stop, seq) AS "end" FROM c WHERE stop IS NOT NULL AND spread < 60 GROUP BY session_id""")
def first_window(spark, sf_dir):
    """T5: the first candidate window that qualifies."""
    w = R.by_seq()
    ahead = w.rowsBetween(0, 4)
    c = samples(spark, sf_dir).select("session_id", "seq", F.lead("seq", 5).over(w).alias("stop"), (F.max("signal").over(ahead) - F.min("signal").over(ahead)).alias("spread"))
    return c.where("stop IS NOT NULL AND spread < 60").groupBy("session_id").agg(F.min("seq").alias("start"), F.min_by("stop", "seq").alias("end"))


WIDTH, LEAST = 7_200_000_000, 1_800_000_000


@query(S + f""", b AS (SELECT session_id, micros, sum(nw) OVER (PARTITION BY session_id ORDER BY seq) AS block FROM (SELECT *, CASE WHEN micros - lag(micros) OVER (PARTITION BY session_id ORDER BY seq) > {GAP} THEN 1 ELSE 0 END AS nw FROM s WHERE active = 1)),
k AS (SELECT session_id, block, min(micros) AS a, max(micros) AS b FROM b GROUP BY session_id, block),
z AS (SELECT session_id, block, b, unnest(range(a, b, {WIDTH})) AS s0 FROM k), y AS (SELECT session_id, block, s0 AS start, least(s0 + {WIDTH}, b) AS stop FROM z),
n AS (SELECT y.session_id, y.start, y.stop, count(b.micros) AS n_samples FROM y JOIN b ON b.session_id = y.session_id AND b.block = y.block AND b.micros BETWEEN y.start AND y.stop WHERE y.stop - y.start >= {LEAST} GROUP BY y.session_id, y.start, y.stop),
p AS (SELECT session_id, lag(b) OVER (PARTITION BY session_id ORDER BY block) AS a, a AS b FROM k WHERE b > a), q AS (SELECT session_id, b, unnest(range(a, b, {WIDTH})) AS s0 FROM p WHERE b - a > {LEAST}),
g AS (SELECT session_id, s0 AS start, least(s0 + {WIDTH}, b) AS stop FROM q)
SELECT session_id, start, stop, false AS is_blank, n_samples FROM n UNION ALL SELECT session_id, start, stop, true, 0 FROM g WHERE stop - start > {LEAST}""")
def anchored_buckets(spark, sf_dir):
    """H2: buckets anchored at each block, both ends inclusive, and blank buckets in long gaps between blocks."""
    s = R.sessionize(samples(spark, sf_dir).where("active = 1"), "micros", GAP).select("session_id", "block", F.col("micros").alias("at"))
    return J.anchored_buckets(s, WIDTH, LEAST)


@query(T + """, g AS (SELECT block_id, stddev_pop(force) AS sf, avg(force) AS mf, stddev_pop(accel) AS sa, avg(accel) AS ma FROM t GROUP BY block_id),
k AS (SELECT t.block_id, CASE WHEN any_value(sf) > 0 THEN avg(pow((force - mf) / sf, 3)) END AS s1, CASE WHEN any_value(sa) > 0 THEN avg(pow((accel - ma) / sa, 3)) END AS s2 FROM t JOIN g ON t.block_id = g.block_id GROUP BY t.block_id)
SELECT block_id, CASE WHEN s1 < -0.35 AND s2 > 0.35 THEN 'left' WHEN s1 > 0.35 AND s2 < -0.35 THEN 'right' ELSE 'undecided' END AS foot_1 FROM k""")
def left_right_by_skew(spark, sf_dir):
    """Which foot is left, by the skewness of both pitches."""
    t = steps(spark, sf_dir)
    skew = lambda c: F.when(F.stddev_pop(c) > 0, F.skewness(c))
    return t.groupBy("block_id").agg(PL.left_by_skew(skew("force"), skew("accel")).alias("foot_1"))


@query("""WITH r AS (SELECT vec_id, label % 4 AS expected, CAST(floor(abs(embedding[1]) * 10) AS INT) % 4 AS guess FROM embeddings)
SELECT expected AS code, count(*) AS n, round(100.0 * count(*) FILTER (WHERE guess = expected) / count(*), 6) AS perc_correct FROM r GROUP BY expected""")
def accuracy_by_code(spark, sf_dir):
    """First-ranked answers against the expected code of each recording, in percent by code."""
    e = table(spark, sf_dir, "embeddings")
    r = e.select((F.col("label") % 4).alias("expected"), (F.floor(F.abs(F.col("embedding")[0].cast("double")) * 10).cast("int") % 4).alias("guess"))
    return PL.accuracy(r, "expected", "guess")


@query("""WITH m AS (SELECT * FROM (VALUES (0, 'ACE'), (0, 'XCE'), (1, 'BCE'), (2, 'ADE'), (3, 'BDF')) AS v(label, condition)),
x AS (SELECT condition, 0 AS sensor, embedding[1] AS v FROM embeddings e JOIN m ON e.label = m.label UNION ALL SELECT condition, 1, embedding[2] FROM embeddings e JOIN m ON e.label = m.label),
b AS (SELECT condition, s.order_ AS sensor_order, CASE WHEN s.order_ = '012' THEN sensor ELSE 1 - sensor END AS foot, CAST(least(greatest(floor(v * 4), -4), 4) AS INT) AS bin FROM x, (VALUES ('012'), ('210')) AS s(order_))
SELECT condition, sensor_order, foot, bin, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY condition, sensor_order, foot), 6) AS pct FROM b GROUP BY condition, sensor_order, foot, bin""")
def trained_placement(spark, sf_dir):
    """Histograms of labelled recordings for every condition that a label stands for, in both sensor orders."""
    e = table(spark, sf_dir, "embeddings")
    conditions = spark.createDataFrame([(0, "ACE"), (0, "XCE"), (1, "BCE"), (2, "ADE"), (3, "BDF")], "label int, condition string")
    values = e.select("label", F.posexplode(F.slice("embedding", 1, 2)).alias("sensor", "v"))
    return PL.train(values, conditions, F.least(F.greatest(F.floor(F.col("v") * 4), F.lit(-4)), F.lit(4)).cast("int"))


RATE = S + """, c AS (SELECT *, CASE WHEN phase = {v} AND lag(phase) OVER (PARTITION BY session_id ORDER BY seq) = {v} THEN 0 ELSE 1 END AS ch, event_id % 6 IN (3, 5) AS dbl, CASE WHEN signal < 10 THEN 0 ELSE signal END AS x,
  CASE WHEN lag(signal) OVER (PARTITION BY session_id ORDER BY seq) < 10 THEN 0 ELSE lag(signal) OVER (PARTITION BY session_id ORDER BY seq) END AS px, max(seq) OVER (PARTITION BY session_id) AS last FROM s),
r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run FROM c), f AS (SELECT * FROM r WHERE phase = {v}),
"""


@query(RATE.format(v=2) + """g AS (SELECT session_id, run, min(CASE WHEN x <> 0 THEN seq END) AS first, max(x) AS high FROM f GROUP BY session_id, run),
t AS (SELECT f.session_id, f.run, min(f.seq) AS top FROM f JOIN g ON f.session_id = g.session_id AND f.run = g.run AND f.x = g.high GROUP BY f.session_id, f.run),
l AS (SELECT g.session_id, g.run, first, high, f.px AS low FROM g JOIN f ON f.session_id = g.session_id AND f.run = g.run AND f.seq = g.first),
k AS (SELECT l.session_id, l.run, CASE WHEN first > 0 AND high > low AND top > first - 1 THEN (high - low) / ((top - first + 1) / 100.0) ELSE 0.0 END AS v FROM l JOIN t ON l.session_id = t.session_id AND l.run = t.run)
SELECT f.session_id, f.seq, round(coalesce(k.v, 0) / CASE WHEN f.dbl THEN 2 ELSE 1 END, 4) AS rate FROM f LEFT JOIN k ON f.session_id = k.session_id AND f.run = k.run""")
def force_absorption(spark, sf_dir):
    """from the sample before the first force of an impact to its peak; halved in double stances."""
    s = samples(spark, sf_dir).withColumn("x", F.when(F.col("signal") < 10, 0.0).otherwise(F.col("signal"))).withColumn("double_leg", (F.col("event_id") % 6).isin(3, 5))
    return rates.absorption(s, F.col("phase") == 2, "x", F.col("double_leg"), 100.0).select("session_id", "seq", F.round("rate", 4).alias("rate"))


@query(RATE.format(v=3) + """g AS (SELECT session_id, run, max(x) AS high FROM f GROUP BY session_id, run),
t AS (SELECT f.session_id, f.run, min(f.seq) AS top, any_value(high) AS high FROM f JOIN g ON f.session_id = g.session_id AND f.run = g.run AND f.x = g.high GROUP BY f.session_id, f.run),
a AS (SELECT f.session_id, f.run, f.seq, f.x, t.top, t.high FROM f JOIN t ON f.session_id = t.session_id AND f.run = t.run AND f.seq >= t.top),
m AS (SELECT session_id, run, any_value(top) AS top, any_value(high) AS high, min(CASE WHEN x = 0 THEN seq END) AS zero, arg_min(seq, x * 1000000 + seq) AS low FROM a GROUP BY session_id, run),
e AS (SELECT m.*, CASE WHEN zero IS NOT NULL THEN zero ELSE low + 1 END AS stop FROM m), n AS (SELECT session_id, max(seq) AS last FROM s GROUP BY session_id),
u AS (SELECT e.session_id, e.run, top, high, least(stop, last) AS stop FROM e JOIN n ON e.session_id = n.session_id),
k AS (SELECT u.session_id, u.run, CASE WHEN stop > top THEN abs(c.x - high) / ((stop - top) / 100.0) ELSE 0.0 END AS v FROM u JOIN c ON c.session_id = u.session_id AND c.seq = u.stop)
SELECT f.session_id, f.seq, round(coalesce(k.v, 0) / CASE WHEN f.dbl THEN 2 ELSE 1 END, 4) AS rate FROM f LEFT JOIN k ON f.session_id = k.session_id AND f.run = k.run""")
def force_production(spark, sf_dir):
    """from the peak of a take-off to the first zero after it, else to just after its lowest; halved in double stances."""
    s = samples(spark, sf_dir).withColumn("x", F.when(F.col("signal") < 10, 0.0).otherwise(F.col("signal"))).withColumn("double_leg", (F.col("event_id") % 6).isin(3, 5))
    return rates.production(s, F.col("phase") == 3, "x", F.col("double_leg"), 100.0).select("session_id", "seq", F.round("rate", 4).alias("rate"))


@query(S + """, a AS (SELECT session_id, seq, phase, event_id * 7 % 4 AS phase_rf, sin(signal) AS hr, cos(signal) AS fr, sin(signal * 2) * 3 AS fy, cos(signal * 3) * 3 AS hy FROM s)
SELECT session_id, seq, round(CASE WHEN phase IN (0, 2, 3) THEN -degrees(hr) END, 5) + 0.0 AS hip_drop_lf, round(CASE WHEN phase_rf IN (0, 2, 3) THEN degrees(hr) END, 5) + 0.0 AS hip_drop_rf,
  round(CASE WHEN phase IN (0, 2, 3) THEN -degrees(fr) END, 5) + 0.0 AS ankle_rot_lf, round(CASE WHEN phase IN (0, 2, 3) THEN -degrees(atan2(sin(fy - hy), cos(fy - hy))) END, 5) + 0.0 AS foot_position_lf FROM a""")
def rotation_measures(spark, sf_dir):
    """hip drop, ankle rotation and foot position as rotations against neutral, while the foot is on the ground."""
    x = F.col("signal")
    a = samples(spark, sf_dir).select("session_id", "seq", "phase", (F.col("event_id") * 7 % 4).alias("phase_rf"), F.sin(x).alias("hr"), F.cos(x).alias("fr"), (F.sin(x * 2) * 3).alias("fy"), (F.cos(x * 3) * 3).alias("hy"))
    cells = {
        "hip_drop_lf": rates.rotation_on_ground(F.col("hr"), None, F.col("phase"), -1), "hip_drop_rf": rates.rotation_on_ground(F.col("hr"), None, F.col("phase_rf"), 1),
        "ankle_rot_lf": rates.rotation_on_ground(F.col("fr"), None, F.col("phase"), -1), "foot_position_lf": rates.rotation_on_ground(F.col("fy"), F.col("hy"), F.col("phase"), -1),
    }
    return a.select("session_id", "seq", *((F.round(c, 5) + F.lit(0.0)).alias(n) for n, c in cells.items()))


@query(S + """, l AS (SELECT * FROM s WHERE event_type = 'click'), r AS (SELECT * FROM s WHERE event_type = 'purchase')
SELECT l.session_id, l.seq AS lf_seq, r.seq AS rf_seq, CAST(r.micros - l.micros AS DOUBLE) / 1000 AS land_time_ms, round(degrees(l.signal), 4) AS lf_pattern, round(degrees(r.signal), 4) AS rf_pattern
FROM l JOIN r ON l.session_id = r.session_id AND abs(l.micros - r.micros) <= 1800000000""")
def landings(spark, sf_dir):
    """landing time (right after left is positive) and the pitch of each foot at its own first contact."""
    s = samples(spark, sf_dir)
    side = lambda kind, p: s.where(F.col("event_type") == kind).select("session_id", F.col("seq").alias(f"{p}_seq"), F.col("micros").alias(f"{p}_at"), F.round(F.degrees("signal"), 4).alias(f"{p}_pattern"))
    met = J.band_join(side("click", "lf"), side("purchase", "rf"), ["session_id"], "lf_at", "rf_at", 1_800_000_000)
    return met.select("session_id", "lf_seq", "rf_seq", ((F.col("rf_at") - F.col("lf_at")) / 1000).alias("land_time_ms"), "lf_pattern", "rf_pattern")


@query(S.replace("WITH s", "WITH RECURSIVE s", 1) + """, g AS (SELECT session_id, seq AS start, seq + seq * 7 % 5 + 3 AS stop, row_number() OVER (PARTITION BY session_id ORDER BY seq) AS i FROM s WHERE phase = 0),
p AS (SELECT session_id, seq AS spot, signal AS pitch, row_number() OVER (PARTITION BY session_id ORDER BY seq) - 1 AS k FROM s WHERE event_type IN ('click', 'purchase')),
c AS (SELECT g.session_id, g.i, g.start, g.stop, count(p.spot) AS gone FROM g LEFT JOIN p ON p.session_id = g.session_id AND p.spot < g.start GROUP BY ALL),
q(session_id, i, head, start, stop, spot, pitch) AS (SELECT DISTINCT session_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM g
UNION ALL SELECT q.session_id, q.i + 1, greatest(q.head, c.gone) + CASE WHEN p.spot <= c.stop THEN 1 ELSE 0 END, c.start, c.stop, CASE WHEN p.spot <= c.stop THEN p.spot END, p.pitch
FROM q JOIN c ON c.session_id = q.session_id AND c.i = q.i + 1 LEFT JOIN p ON p.session_id = q.session_id AND p.k = greatest(q.head, c.gone))
SELECT session_id, start, stop AS "end", spot AS "at", pitch FROM q WHERE spot IS NOT NULL""")
def queue_match(spark, sf_dir):
    """A queue of points of one foot, purged and consumed by (overlapping) ranges of the other, in order."""
    s = samples(spark, sf_dir)
    found = s.where("phase = 0").select("session_id", F.col("seq").alias("start"), (F.col("seq") + F.col("seq") * 7 % 5 + 3).alias("end"))
    points = s.where("event_type IN ('click', 'purchase')").select("session_id", F.col("seq").alias("at"), F.col("signal").alias("pitch"))
    return J.queue_match(found, points)


SENSORS = [f"{k}_{s}_{a}" for k in ("acc", "euler") for s in ("lf", "hip", "rf") for a in "xyz"]
FEATURES = force.FEATURES


def _feature_sql() -> str:
    values = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) * 4 AS {c}" for i, c in enumerate(SENSORS))
    totals = ", ".join(f"sqrt(acc_{s}_x * acc_{s}_x + acc_{s}_y * acc_{s}_y + acc_{s}_z * acc_{s}_z) AS acc_{s}" for s in ("lf", "hip", "rf"))
    steps_ = ", ".join(f"{c} - lag({c}) OVER w AS {c}_d0" for c in (*SENSORS, "acc_lf", "acc_hip", "acc_rf"))
    cut = ", ".join((f"CASE WHEN abs({c}_d0) > 3.0 THEN 0 ELSE {c}_d0 END" if c.startswith("euler") else f"{c}_d0") + f" AS {c}_d" for c in (*SENSORS, "acc_lf", "acc_hip", "acc_rf"))
    out = ", ".join(f"round({c}, 5) + 0.0 AS {c}" for c in FEATURES)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
    return f"""WITH v AS (SELECT label AS session_id, vec_id AS seq, {values} FROM embeddings), t AS (SELECT *, {totals} FROM v), d AS (SELECT *, {steps_} FROM t WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
c AS (SELECT *, {cut} FROM d) SELECT session_id, seq, {out}, 70.0::DOUBLE AS mass FROM c WHERE {whole}"""


@query(_feature_sql())
def force_features(spark, sf_dir):
    """the 31 features of force and the mass; rows with a missing one are left out (filtering and scaling follow in :mod:`force`)."""
    e = table(spark, sf_dir, "embeddings")
    s = e.select(F.col("label").alias("session_id"), F.col("vec_id").alias("seq"), *((F.col("embedding")[i].cast("double") * 4).alias(c) for i, c in enumerate(SENSORS)))
    f = force.features(s, F.lit(70.0))
    return f.select("session_id", "seq", *((F.round(c, 5) + F.lit(0.0)).alias(c) for c in force.FEATURES), "mass")


@query(_feature_sql().replace("SELECT session_id, seq, round", "SELECT session_id, seq, round(greatest(0.02 * acc_lf + 0.01 * acc_hip_z, 0), 5) + 0.0 AS grf_lf, round(greatest(0.02 * acc_rf + 0.01 * acc_hip_z, 0), 5) + 0.0 AS grf_rf, round", 1).split(", round(acc_lf_z")[0] + " FROM c WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES))
def force_prediction(spark, sf_dir):
    """Forces by a model handed in; here a documented linear one, since no trained weights exist."""
    e = table(spark, sf_dir, "embeddings")
    s = e.select(F.col("label").alias("session_id"), F.col("vec_id").alias("seq"), *((F.col("embedding")[i].cast("double") * 4).alias(c) for i, c in enumerate(SENSORS)))
    out = force.predict(force.features(s, F.lit(70.0)), force.LINEAR)
    return out.select("session_id", "seq", *((F.round(c, 5) + F.lit(0.0)).alias(c) for c in ("grf_lf", "grf_rf")))


@query(E + """, m AS (SELECT label, avg(pw) AS w, avg(px) AS x, avg(py) AS y, avg(pz) AS z FROM e WHERE vec_id % 100 BETWEEN 10 AND 35 GROUP BY label), k AS (SELECT *, sqrt(w*w+x*x+y*y+z*z) AS n FROM m),
u AS (SELECT label, w/n AS w, x/n AS x, y/n AS y, z/n AS z FROM k) SELECT label, round(w, 6) + 0.0 AS w, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z, round(atan2(2*(x*y+w*z), 1-2*(y*y+z*z)) - pi(), 5) + 0.0 AS heading FROM u""")
def reference_orientation(spark, sf_dir):
    """Mean orientation of a still window (its end counts) and the heading of the reference."""
    p, _, _ = _columns()
    inside = _view(spark, sf_dir).where("vec_id % 100 BETWEEN 10 AND 35")
    mean = inside.groupBy("label").agg(*(c.alias(n) for n, c in zip(WXYZ, Q.mean(p))))
    r = tuple(F.col(c) for c in WXYZ)
    return mean.select("label", *_out((*r,), WXYZ), (F.round(Q.heading_of(r), 5) + F.lit(0.0)).alias("heading"))


@query(S + """, v AS (SELECT session_id, seq, CASE WHEN event_id % 4 = 0 THEN 0 ELSE active END AS on_, signal AS grf, signal / 10 AS accel, phase FROM s),
u AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY session_id ORDER BY seq) AS BIGINT) AS unit FROM (SELECT *, CASE WHEN phase <> lag(phase) OVER (PARTITION BY session_id ORDER BY seq) THEN 1 ELSE 0 END AS nw FROM v)),
g AS (SELECT session_id, unit, grouping(unit) AS lvl, count(*) FILTER (WHERE on_ = 1) AS n_active, round(sum(accel * on_), 5) AS total_accel, round(sum(CASE WHEN grf > 60 THEN accel * 1.5 ELSE accel END * on_), 5) AS irregular_accel,
  round(sum(grf * on_ * abs(accel)) / nullif(sum(on_ * abs(accel)), 0), 5) AS weighted_grf FROM u GROUP BY GROUPING SETS ((session_id), (session_id, unit)))
SELECT session_id, unit, n_active, total_accel, irregular_accel, weighted_grf FROM g""")
def one_sensor_blocks(spark, sf_dir):
    """Blocks of one sensor and their unit blocks, with masked and irregular acceleration."""
    on = F.when(F.col("event_id") % 4 == 0, 0).otherwise(F.col("active"))
    v = samples(spark, sf_dir).select("session_id", "seq", "phase", on.alias("on"), F.col("signal").alias("grf"), (F.col("signal") / 10).alias("accel"))
    u = R.cut_at_changes(v, "phase")
    irregular = F.when(F.col("grf") > 60, F.col("accel") * 1.5).otherwise(F.col("accel"))
    weight = F.col("on") * F.abs("accel")
    sets = u.groupingSets([[F.col("session_id")], [F.col("session_id"), F.col("unit")]], F.col("session_id"), F.col("unit"))
    return sets.agg(
        F.count_if(F.col("on") == 1).alias("n_active"), F.round(F.sum(F.col("accel") * F.col("on")), 5).alias("total_accel"), F.round(F.sum(irregular * F.col("on")), 5).alias("irregular_accel"),
        F.round(F.try_divide(F.sum(F.col("grf") * weight), F.sum(weight)), 5).alias("weighted_grf"),
    )


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN c_mktsegment || ',' || c_name WHEN 3 THEN NULL ELSE '["' || c_name || '"]' END AS value FROM customer""")
def decoded_attributes(spark, sf_dir):
    """Attributes tagged by type (S, N, SS, L, NULL) as text."""
    from stridelake.functions.metadata import decoded_attribute

    k = F.col("c_custkey") % 5
    tagged = (
        F.when(k == 0, F.to_json(F.struct(F.col("c_name").alias("S")))).when(k == 1, F.to_json(F.struct(F.col("c_custkey").cast("string").alias("N"))))
        .when(k == 2, F.to_json(F.struct(F.array("c_mktsegment", "c_name").alias("SS")))).when(k == 3, F.lit('{"NULL": true}')).otherwise(F.to_json(F.struct(F.array("c_name").alias("L"))))
    )
    read = table(spark, sf_dir, "customer").select("c_custkey", F.from_json(tagged, "S string, N string, SS array<string>, L array<string>, `NULL` boolean").alias("v"))
    return read.select("c_custkey", decoded_attribute(F.col("v")).alias("value"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'CREATE_COMPLETE' WHEN 'F' THEN 'UPLOAD_COMPLETE' END AS session_status, o_orderstatus = 'O' AS accepted FROM orders")
def late_uploads(spark, sf_dir):
    """Uploads of open sessions, and the rejected ones beside them."""
    from stridelake.streaming.sessions import split_late

    s = F.col("o_orderstatus")
    u = table(spark, sf_dir, "orders").select("o_orderkey", F.when(s == "O", "CREATE_COMPLETE").when(s == "F", "UPLOAD_COMPLETE").alias("session_status"))
    kept, rejected = split_late(u)
    return kept.withColumn("accepted", F.lit(True)).unionByName(rejected.withColumn("accepted", F.lit(False)))


@query("""WITH c AS (SELECT o_custkey AS session_id, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'CREATE_COMPLETE' WHEN 1 THEN 'UPLOAD_IN_PROGRESS' WHEN 2 THEN 'UPLOAD_COMPLETE' ELSE 'PROCESSING_COMPLETE' END AS session_status, o_orderdate AS updated FROM orders),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY updated, o_orderkey) AS k FROM c WHERE session_id % 3 > 0) WHERE k = 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY updated DESC, o_orderkey DESC) AS k FROM c) WHERE k = 1)
SELECT coalesce(a.session_id, b.session_id) AS session_id, CASE WHEN a.session_id IS NULL OR (a.session_status || '>' || b.session_status) IN ({allowed}) THEN b.session_status ELSE a.session_status END AS session_status FROM a FULL JOIN b ON a.session_id = b.session_id""".replace("{allowed}", ", ".join(f"'{x}>{y}'" for x, y in TRANSITIONS)))
def applied_changes(spark, sf_dir):
    """A batch of changes merged by key; creating twice and changes that are not allowed do nothing."""
    from stridelake.streaming.sessions import apply_changes

    k = F.col("o_orderkey") % 4
    status = F.when(k == 0, "CREATE_COMPLETE").when(k == 1, "UPLOAD_IN_PROGRESS").when(k == 2, "UPLOAD_COMPLETE").otherwise("PROCESSING_COMPLETE")
    c = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session_id"), status.alias("session_status"), F.struct("o_orderdate", "o_orderkey").alias("updated"))
    first = c.where("session_id % 3 > 0").groupBy("session_id").agg(F.min_by("session_status", "updated").alias("session_status"), F.min("updated").alias("updated"))
    return apply_changes(first, c).select("session_id", "session_status")


@query()
def peak_totals_apart(spark, sf_dir):
    """A4, A5: totals of peaks that are six samples apart, and the 95 % quantile of their heights."""

    def run(c):
        at = signal.detect_peaks(c["signal"], 12.0, 6)
        x = c["signal"][at]
        return {"session_id": c["session_id"][:1], "total": [float(x.sum())], "mean": [float(x.mean()) if len(x) else None], "peak95": [float(np.percentile(x, 95) * 10000) if len(x) >= 2 else 0.0]}

    return signal.per_session(samples(spark, sf_dir).select("session_id", "seq", "signal"), run, "session_id long, total double, mean double, peak95 double")


@query()
def march_headings(spark, sf_dir):
    """Heading of each group of orientations; groups that cannot be calibrated have a code."""
    v = _view(spark, sf_dir).select(F.col("label").cast("long").alias("session_id"), F.col("vec_id").alias("seq"), *(F.col(f"p{c}") for c in WXYZ))

    def run(c):
        q = np.stack([c[f"p{x}"] for x in WXYZ], 1)
        try:
            return {"session_id": c["session_id"][:1], "heading": [calibrate.heading(q, 0)], "code": [None]}
        except calibrate.CalibrationError as e:
            return {"session_id": c["session_id"][:1], "heading": [None], "code": [e.code]}

    return signal.per_session(v, run, "session_id long, heading double, code string", types={"heading": pa.float64(), "code": pa.string()})


@query()
def placement_votes(spark, sf_dir):
    """left or right by the feet's steps and by the hip's correction points, and the decision."""
    x = F.col("signal")
    s = samples(spark, sf_dir).select("session_id", "seq", x.alias("a"), (100 - x).alias("b"), F.sin(x).alias("f"), F.cos(x).alias("g"), (x / 8 - 6).alias("hip"), (F.col("phase") == 1).cast("int").alias("point"), (F.col("phase") == 2).cast("int").alias("t0"), (F.col("phase") == 3).cast("int").alias("t2"))

    def run(c):
        lateral = calibrate.lateral_vote(c["a"], c["b"], c["f"], c["g"], c["hip"])
        hip = calibrate.hip_vote(c["point"], c["t0"], c["t2"])
        return {"session_id": c["session_id"][:1], "lateral": [lateral[0]], "hip": [hip[0]], "placement": [calibrate.placement(hip, lateral)], "weak": [bool(lateral[1] and hip[1])]}

    return signal.per_session(s, run, "session_id long, lateral array<int>, hip array<int>, placement array<int>, weak boolean", types={k: pa.list_(pa.int32()) for k in ("lateral", "hip", "placement")})
