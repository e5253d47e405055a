"""Force models from files, table functions, score weights, payload versions and whole step records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.functions import table_functions
from stridelake.functions.lineage import new_folder
from stridelake.operators import force, payloads, scores
from stridelake.operators.statistics import rounded
from stridelake.plans import guard_queries as GQ
from stridelake.plans import session
from stridelake.plans.range_queries import EXACT, RUNS
from stridelake.plans.register import ORACLE_SQL, S, T, query, samples, steps, table
from stridelake.sources import models


def _motion(spark, sf_dir) -> DataFrame:
    """Embeddings as motion of the three sensors; a label is a session."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").alias("session_id"), F.col("vec_id").alias("seq"), *((F.col("embedding")[i].cast("double") * 4).alias(c) for i, c in enumerate(GQ.SENSORS)))


def _linear(name: str):
    return reduce(lambda a, b: a + b, (F.col(f) * v for f, v in force.LINEAR[name].items()))


def _fitted(found: DataFrame, mass: bool) -> tuple[str, str]:
    """Paths of a scaler and a model of the linear stand-in, fitted on the features at hand."""
    spark = found.sparkSession
    targets = found.withColumns({n: _linear(n) for n in force.LINEAR}).withColumn("grf", F.col("grf_lf") + F.col("grf_rf"))
    scaler, model = models.fit(targets, [*force.FEATURES, *(["mass"] if mass else [])], {n: n for n in ("grf_lf", "grf_rf", "grf")})
    folder = new_folder(spark, "model")
    paths = tuple(f"{folder}/{folder.rsplit('-', 1)[1]}-{n}.json" for n in ("scaler", "model"))
    for thing, path in zip((scaler, model), paths):
        models.save(spark, thing, path)
    return paths


@query(ORACLE_SQL["force_prediction"])
def force_model(spark, sf_dir):
    """Forces by a scaler and a model that were fitted, saved as files and loaded by the workers."""
    found = force.features(_motion(spark, sf_dir), F.lit(70.0))
    out = models.apply_model(found, *_fitted(found, mass=False), force.FEATURES, ["grf_lf", "grf_rf", "grf"])
    return out.select("session_id", "seq", *((F.round(F.greatest(c, F.lit(0.0)), 5) + F.lit(0.0)).alias(c) for c in ("grf_lf", "grf_rf")))


@query()
def force_contacts(spark, sf_dir):
    """Features through 6 Hz, forces by the model's files through 18 Hz, contacts by weight."""
    motion = _motion(spark, sf_dir)
    paths = _fitted(force.features(motion, F.lit(70.0)), mass=True)
    return force.forces(motion, 7.0, *paths)


@query(RUNS.format(flag="(phase = 0)") + EXACT.replace("SELECT session_id", "SELECT CAST(session_id AS VARCHAR) AS session_id"))
def table_ranges(spark, sf_dir):
    """W2 as a table function of SQL."""
    table_functions.register(spark)
    samples(spark, sf_dir).selectExpr("session_id", "seq", "phase = 0 AS flag").createOrReplaceTempView("table_ranges_input")
    return spark.sql("SELECT * FROM session_ranges(TABLE(table_ranges_input) PARTITION BY session_id ORDER BY seq)")


@query()
def table_lowpass(spark, sf_dir):
    """F1, F2 as a table function of SQL."""
    table_functions.register(spark)
    samples(spark, sf_dir).select("session_id", "seq", "signal").createOrReplaceTempView("table_lowpass_input")
    return spark.sql("SELECT * FROM session_lowpass(TABLE(table_lowpass_input) PARTITION BY session_id ORDER BY (seq), 10.0D)")


@query(S + """, k AS (SELECT session_id, seq, 100 - 5 * phase AS symmetry, 90 - 3 * phase AS control, 80.0 + phase AS consistency, signal - 40 AS force, 10 + event_id % 5 AS elapsed FROM s),
m AS (SELECT *, (pow(1 - symmetry / 100.0, 2) + pow(1 - control / 100.0, 2)) / 2 AS d, abs(force) / 10 AS grf FROM k)
SELECT session_id, seq, round(d, 6) AS destr_multiplier, round(grf * d, 9) AS dest_grf, round(grf - grf * d, 9) AS const_grf, round(symmetry * grf, 4) AS symmetry, round(consistency * grf, 4) AS consistency,
round(sum(elapsed) OVER w / sum(elapsed) OVER a, 6) AS session_duration, round(sum(grf) OVER w / sum(grf) OVER a, 6) AS session_grf_elapsed FROM m WINDOW w AS (PARTITION BY session_id ORDER BY seq), a AS (PARTITION BY session_id)""")
def weighted_scores(spark, sf_dir):
    """scores weighted by force, destructive and constructive force, running shares."""
    s = samples(spark, sf_dir).select("session_id", "seq", (100.0 - 5 * F.col("phase")).alias("symmetry"), (90.0 - 3 * F.col("phase")).alias("control"), (80.0 + F.col("phase")).alias("consistency"), (F.col("signal") - 40).alias("force"), (10 + F.col("event_id") % 5).cast("double").alias("elapsed"))
    out = scores.weighted(s, "symmetry", "control", "force", "elapsed", ["consistency"], 10.0)
    digits = {"destr_multiplier": 6, "dest_grf": 9, "const_grf": 9, "symmetry": 4, "consistency": 4, "session_duration": 6, "session_grf_elapsed": 6}
    return out.select("session_id", "seq", *(F.round(c, d).alias(c) for c, d in digits.items()))


@query(S + """ SELECT session_id, seq, round(pow(1 - (90 - 3 * phase) / 100.0, 2), 6) AS destr_multiplier, round(sum(10 + event_id % 5) OVER (PARTITION BY session_id ORDER BY seq) / sum(10 + event_id % 5) OVER (PARTITION BY session_id), 6) AS session_duration FROM s""")
def one_sensor_scores(spark, sf_dir):
    """F25 of one sensor: the destructive share by control alone."""
    s = samples(spark, sf_dir).select("session_id", "seq", (90.0 - 3 * F.col("phase")).alias("control"), (10 + F.col("event_id") % 5).cast("double").alias("elapsed"))
    out = scores.weighted_of_one(s, "control", "elapsed")
    return out.select("session_id", "seq", F.round("destr_multiplier", 6).alias("destr_multiplier"), F.round("session_duration", 6).alias("session_duration"))


#: Measures of the payloads and the columns of steps that stand for them.
_MEASURED = dict(zip(payloads.MEASURES, ("force", "accel / 1000", "discount * 100", "tax * 100", "step * 1.0")))


def _blocks_sql() -> str:
    """Time blocks of sessions (blocks of 50 orders) with medians of both sides, for each measure."""
    parts = " UNION ALL ".join(f"SELECT session_id, time_block, '{m}' AS measure, side, {e} AS v FROM t2" for m, e in _MEASURED.items())
    return T + f""", t2 AS (SELECT CAST(floor(block_id / 50) AS BIGINT) AS session_id, CAST(block_id % 50 // 10 AS INTEGER) AS time_block, side, force, accel, discount, tax, step FROM t WHERE side IS NOT NULL), u AS ({parts}),
b AS (SELECT session_id, time_block, measure, round(quantile_cont(v, 0.5) FILTER (WHERE side = 'LF'), 2) AS l, round(quantile_cont(v, 0.5) FILTER (WHERE side = 'RF'), 2) AS r FROM u GROUP BY ALL),
e AS (SELECT *, abs(l - r) > 4 AS bad, coalesce(l, 0) > 0 OR coalesce(r, 0) > 0 AS event FROM b),
m AS (SELECT session_id, measure, quantile_cont(l, 0.5) AS l, quantile_cont(r, 0.5) AS r, count(*) FILTER (WHERE event AND bad) AS asym, count(*) FILTER (WHERE event) AS n FROM e GROUP BY ALL)
"""


def _sessions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(sessions with their heads and maps, time blocks) from steps; every third session has no pattern."""
    t = steps(spark, sf_dir).where("side IS NOT NULL").withColumn("session_id", F.floor(F.col("block_id") / 50)).withColumn("time_block", F.floor(F.col("block_id") % 50 / 10).cast("int"))
    own = lambda m, s: rounded(F.median(F.when(F.col("side") == s, F.expr(_MEASURED[m]).cast("double"))), 2)
    # Steps move once, to their session; what follows groups and joins by it where they are.
    wide = t.repartition("session_id").groupBy("session_id", "time_block").agg(*(F.struct(F.lit(m).alias("measure"), own(m, "LF").alias("left"), own(m, "RF").alias("right")).alias(m) for m in _MEASURED))
    blocks = wide.select("session_id", "time_block", F.explode(F.array(*_MEASURED)).alias("x")).select("session_id", "time_block", "x.*")
    blocks = blocks.select("*", F.concat(F.lit("t"), "time_block").alias("start_time"), F.concat(F.lit("u"), "time_block").alias("end_time"), F.coalesce(F.abs(F.col("left") - F.col("right")) > 4, F.lit(False)).alias("significant"))
    fits = t.where("session_id % 3 > 0").select("session_id", F.when(F.col("side") == "LF", 1).otherwise(2).alias("side"), "step", "force").repartition("session_id")
    fits = fits.groupBy("session_id", "side", F.col("step").alias("cadence")).agg(F.round(F.avg("force"), 0).alias("elasticity"), F.count("*").alias("obs")).withColumn("pattern", F.explode(F.array(*map(F.lit, payloads.PATTERNS))))
    stats = fits.select("session_id", "pattern", "side", "cadence", "elasticity", (F.col("cadence") - 3.0).alias("elasticity_t"), F.lit(0.5).alias("elasticity_se"), (F.col("obs") + 90).alias("obs"), (F.col("cadence") * 2.0).alias("adf"), F.lit(7.0).alias("adf_critical"))
    heads = payloads.summaries(blocks).select("session_id", F.concat(F.lit("user"), "session_id").alias("user_id"), F.lit("2024-01-01").alias("event_date"), F.when(F.col("session_id") % 2 == 0, "2024-01-02").alias("end_date"), (F.col("session_id") * 10).alias("seconds_duration"), "asymmetry")
    return heads.join(payloads.time_blocks(blocks), "session_id").join(payloads.pattern_stats(stats), "session_id", "left"), blocks


_VERSION = "['4_3', '4_4', '4_5', '4_6', '4_7'][CAST(session_id % 5 AS INTEGER) + 1]"


def _bodies_sql() -> str:
    """The JSON of each version, put together as text."""
    v = lambda e: f"coalesce(CAST({e} AS VARCHAR), 'null')"
    head = """'{"event_date":"2024-01-01","session_id":' || session_id || ',"seconds_duration":' || session_id * 10"""
    end = """CASE WHEN session_id % 2 = 0 THEN ',"end_date":"2024-01-02"' ELSE ',"end_date":null' END"""
    picks = ", ".join(f"max(CASE WHEN measure = '{m}' THEN s END) AS {m}" for m in payloads.MEASURES)
    nested = lambda ms: "',\"asymmetry\":{' || " + " || ',' || ".join(f"'\"{m}\":' || {m}" for m in ms) + " || '}'"
    sides = """'{"left":{"elasticity":' || le || ',"y_adf":' || la || '},"right":{"elasticity":' || re || ',"y_adf":' || ra || '}}'"""
    patterns = lambda ps: "CASE WHEN le IS NULL THEN '' ELSE ',\"movement_patterns\":{' || " + " || ',' || ".join(f"'\"{p}\":' || {sides}" for p in ps) + " || '}' END"
    flat = f"""',"asymmetry":{{"left_apt":' || {v('al')} || ',"right_apt":' || {v('ar')} || ',"asymmetric_events":' || aa || ',"symmetric_events":' || an - aa || '}}}}'"""
    return _blocks_sql() + f""", j AS (SELECT session_id, measure, l, r, asym, n, '{{"left":' || {v('l')} || ',"right":' || {v('r')} || ',"asymmetric_events":' || asym || ',"symmetric_events":' || n - asym || ',"percent_events_asymmetric":' || CAST(coalesce(round_even(asym * 100.0 / nullif(n, 0), 0), 0) AS BIGINT) || '}}' AS s FROM m),
p AS (SELECT session_id, {picks}, max(CASE WHEN measure = 'apt' THEN l END) AS al, max(CASE WHEN measure = 'apt' THEN r END) AS ar, max(CASE WHEN measure = 'apt' THEN asym END) AS aa, max(CASE WHEN measure = 'apt' THEN n END) AS an FROM j GROUP BY session_id),
f AS (SELECT session_id, side, step, round(avg(force), 0) AS e, count(*) + 90 AS obs FROM t2 WHERE session_id % 3 > 0 GROUP BY ALL),
b2 AS (SELECT session_id, side, arg_max(e, obs * 100 - step) FILTER (WHERE abs(step - 3) >= 2 AND obs >= 100) AS e, arg_max(step * 2.0, obs * 100 - step) FILTER (WHERE step * 2.0 > 7 AND obs >= 100) AS a FROM f GROUP BY ALL),
w AS (SELECT session_id, CAST(coalesce(max(CASE WHEN side = 'LF' THEN e END), 0) AS DOUBLE) AS le, CAST(coalesce(max(CASE WHEN side = 'LF' THEN a END), 0) AS DOUBLE) AS la, CAST(coalesce(max(CASE WHEN side = 'RF' THEN e END), 0) AS DOUBLE) AS re, CAST(coalesce(max(CASE WHEN side = 'RF' THEN a END), 0) AS DOUBLE) AS ra FROM b2 GROUP BY session_id),
x AS (SELECT *, {_VERSION} AS version FROM p LEFT JOIN w USING (session_id))
SELECT session_id, version, CASE version WHEN '4_3' THEN {head} || ',"user_id":"user' || session_id || '"' || {flat} WHEN '4_4' THEN {head} || {flat} WHEN '4_5' THEN {head} || {end} || {nested(payloads.MEASURES[:3])} || '}}'
WHEN '4_6' THEN {head} || {end} || {nested(payloads.MEASURES[:3])} || {patterns(payloads.PATTERNS[:6])} || '}}' ELSE {head} || {end} || {nested(payloads.MEASURES)} || {patterns(payloads.PATTERNS)} || '}}' END AS body FROM x"""


@query(_bodies_sql())
def payload_bodies(spark, sf_dir):
    """The JSON that each of the five versions sends."""
    heads, _ = _sessions(spark, sf_dir)
    version = F.element_at(F.array(*map(F.lit, payloads.VERSIONS)), (F.col("session_id") % 5 + 1).cast("int"))
    return payloads.payloads(heads.withColumn("version", version)).select("session_id", "version", "body")


@query()
def payload_records(spark, sf_dir):
    """Kept records, pattern statistics and reserves of the five versions."""
    heads, _ = _sessions(spark, sf_dir)
    version = F.element_at(F.array(*map(F.lit, payloads.VERSIONS)), (F.col("session_id") % 5 + 1).cast("int"))
    return payloads.payloads(heads.withColumn("version", version)).select("session_id", "version", "record", "patterns", "reserve")


@query()
def whole_step_records(spark, sf_dir):
    """Contacts of both feet with sums, peaks, quantiles and all measures of motion."""
    x = F.col("signal")
    motion = {f"euler_{s}_{a}": F.sin(x / (7 + i) + k) / 3 for k, s in enumerate(("lf", "hip", "rf")) for i, a in enumerate("xyz")}
    other = {"acc_hip_z": x / 20, "total_accel": x / 10, "acc_lf_z": x / 30 - 1, "acc_rf_z": 2 - x / 25, "grf_lf": x * 2, "grf_rf": x * 3}
    s = samples(spark, sf_dir).select("session_id", "seq", (F.col("seq") * 10).alias("epoch_ms"), F.lit(1).alias("active"), ((F.col("seq") % 30 < 14).cast("int") * 2).alias("phase_lf"), ((F.col("seq") % 30 >= 15).cast("int") * 2).alias("phase_rf"), *(v.alias(n) for n, v in (motion | other).items()))
    return session.steps(s)
