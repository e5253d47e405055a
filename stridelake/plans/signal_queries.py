"""Signal operators over sessions; SQL cannot express them, tests hold them against analytic signals."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stridelake.operators import drift as D
from stridelake.operators import phases as P
from stridelake.operators import ranges as R
from stridelake.operators import scores as C
from stridelake.operators import signal as G
from stridelake.operators import step_measures as M
from stridelake.operators.direction import changes_of_direction
from stridelake.plans.register import S, query, samples, steps


def _session(spark, sf_dir):
    return samples(spark, sf_dir).select("session_id", "seq", "signal", "active")


def _own(c, **columns):
    return {"session_id": c["session_id"], "seq": c["seq"], **columns}


@query()
def lowpass_filter(spark, sf_dir):
    """zero-phase low-pass; sessions too short for the extension (15 samples) have no filtered values."""

    def run(c):
        x = c["signal"]
        return _own(c, filtered=G.filter_data(x, "low", high=10.0) if len(x) > 15 else pa.nulls(len(x), pa.float64()))

    return G.per_session(_session(spark, sf_dir), run, "session_id long, seq long, filtered double")


@query()
def peaks_apart(spark, sf_dir):
    """peaks of a least height and distance."""

    def run(c):
        at = G.detect_peaks(c["signal"], 20.0, 6)
        return {"session_id": c["session_id"][at], "seq": c["seq"][at], "height": c["signal"][at]}

    return G.per_session(_session(spark, sf_dir), run, "session_id long, seq long, height double")


@query()
def fft_spectrum(spark, sf_dir):
    """the strongest frequency of each session and its magnitude."""

    def run(c):
        frequency, magnitude = G.spectrum(c["signal"] - c["signal"].mean(), 100.0)
        k = int(np.argmax(magnitude))
        return {"session_id": c["session_id"][:1], "frequency": frequency[k : k + 1], "magnitude": magnitude[k : k + 1]}

    return G.per_session(_session(spark, sf_dir), run, "session_id long, frequency double, magnitude double")


@query()
def cadence_zones(spark, sf_dir):
    """cadence zones with their hysteresis."""

    def run(c):
        return _own(c, zone=G.cadence_zones(np.ones(len(c["seq"])), c["signal"] / 100, hold=10) if len(c["seq"]) > 27 else np.zeros(len(c["seq"]), int))

    return G.per_session(_session(spark, sf_dir), run, "session_id long, seq long, zone long")


@query()
def adf_test(spark, sf_dir):
    """H4: unit-root test of each session."""

    def run(c):
        statistic, critical = G.dickey_fuller(c["signal"])
        return {"session_id": c["session_id"][:1], "statistic": [statistic], "critical": [critical]}

    return G.per_session(_session(spark, sf_dir), run, "session_id long, statistic double, critical double")


@query()
def symmetry_density(spark, sf_dir):
    """mean agreement (0 to 1) of left and right densities, by block of orders."""
    t = steps(spark, sf_dir).select(F.floor(F.col("block_id") / 100).alias("session_id"), "side", "force")
    return C.symmetry(t, ["session_id"], "side", "force").groupBy("session_id").agg((F.avg("symmetry") / 100).alias("score"))


@query()
def symmetry_scores(spark, sf_dir):
    """agreement of left and right densities at each step's value, by block of orders."""
    t = steps(spark, sf_dir).select(F.floor(F.col("block_id") / 100).alias("session_id"), "block_id", "step", "side", "accel")
    return C.symmetry(t, ["session_id"], "side", "accel")


@query(S + """, k AS (SELECT session_id, seq, signal, (signal - avg(signal) OVER w) * (signal - avg(signal) OVER w) / (count(*) OVER w * var_pop(signal) OVER w) AS ratio, count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY session_id)),
e AS (SELECT session_id, quantile_cont(ratio, 0.05) AS best, quantile_cont(ratio, 0.95) AS worst FROM k GROUP BY session_id)
SELECT session_id, seq, CASE WHEN n >= 5 THEN round(greatest(least((1 - (ratio - best) / (worst - best)) * 100, 100), 0), 5) END AS score FROM k JOIN e USING (session_id)""")
def consistency_scores(spark, sf_dir):
    """squared deviations of each session, scaled between their 5th and 95th percentiles."""
    s = samples(spark, sf_dir).select("session_id", "seq", "signal")
    return C.consistency(s, ["session_id"], "signal", "score").select("session_id", "seq", F.round("score", 5).alias("score"))


@query()
def consistency_of_two(spark, sf_dir):
    """as above within the likelier of two normal components, found by expectation maximisation."""
    s = samples(spark, sf_dir).select("session_id", "seq", "signal")
    return C.consistency_of_two(s, ["session_id"], "signal", "score")


@query()
def unit_activity(spark, sf_dir):
    """Filtered total acceleration over a level, gaps bridged, short activity dropped."""

    def run(c):
        x = c["signal"]
        return _own(c, active=((G.filter_data(x, "low", high=1.0) if len(x) > 15 else x) >= 40).astype(int))

    filtered = G.per_session(_session(spark, sf_dir).drop("active"), run, "session_id long, seq long, active long")
    return R.fill_short_runs(R.fill_short_runs(filtered, "active", 0, 3, 1), "active", 1, 6, 0)


@query()
def direction_changes(spark, sf_dir):
    """Strides whose heading differs from that of six strides before, and the samples around them."""

    def run(c):
        heading = (c["signal"] * 7) % 360 - 180
        return _own(c, change_of_direction=changes_of_direction(c["signal"] / 20, heading, distance=2, back=3, bridge=4))

    return G.per_session(_session(spark, sf_dir), run, "session_id long, seq long, change_of_direction long")


@query()
def drift_filtered(spark, sf_dir):
    """F8: orientations without the slow part of their roll and pitch."""

    def run(c):
        half = np.radians(c["signal"]) / 8
        q = np.stack((np.cos(half), np.sin(half) * 0.6, np.sin(half) * 0.8, np.zeros(len(half))), 1)
        out = D.drift_filter(q, 100.0)
        return _own(c, **{x: out[:, i] for i, x in enumerate("wxyz")})

    return G.per_session(_session(spark, sf_dir), run, "session_id long, seq long, w double, x double, y double, z double")


@query()
def adaptive_troughs(spark, sf_dir):
    """troughs after main peaks, found while the sensor moves."""

    def run(c):
        x = (c["signal"] - 50) * 20
        at = D.rhythm_points(x, 400.0, 3, c["moving"])
        at = at[at < len(x)]
        return {"session_id": c["session_id"][at], "seq": c["seq"][at], "depth": x[at - 1]}

    moving = (F.col("event_id") % 7 > 0).cast("int").alias("moving")
    return G.per_session(samples(spark, sf_dir).select("session_id", "seq", "signal", moving), run, "session_id long, seq long, depth double")


@query()
def drift_corrected(spark, sf_dir):
    """orientations of a foot without drift, with the candidates and the points that were used.

    The test sessions are short, so windows and limits are a thirtieth of a recording's.
    """
    sensor = replace(D.FOOT, window=32, points=1, tail=4, peak_share=0.1)

    def run(c):
        half = np.radians(c["signal"]) / 8
        q = np.stack((np.cos(half), np.sin(half) * 0.6, np.sin(half) * 0.8, np.zeros(len(half))), 1)
        pull = (c["signal"] - 50) * 60
        out, candidates, used = D.correct_drift(q, np.stack((pull, pull * 0, pull * 0 + 1000), 1), c["moving"], sensor)
        marks = {n: np.isin(np.arange(len(q)), at).astype(int) for n, at in (("candidate", candidates), ("point", used))}
        return _own(c, **{x: out[:, i] for i, x in enumerate("wxyz")}, **marks)

    moving = (F.col("seq") % 90 < 64).cast("int").alias("moving")
    return G.per_session(samples(spark, sf_dir).select("session_id", "seq", "signal", moving), run, "session_id long, seq long, w double, x double, y double, z double, candidate long, point long")


def _feet(spark, sf_dir):
    s = samples(spark, sf_dir)
    x = F.col("signal")
    return s.select("session_id", "seq", "micros", "phase", "active", (x / 20).alias("acc_hip_z"), F.sin(x).alias("acc_hip_x"), (x / 10).alias("total_accel"), (x / 30 - 1).alias("acc_lf_z"), (2 - x / 25).alias("acc_rf_z"), (x * 2).alias("grf_lf"), (x * (F.col("phase") % 2)).alias("grf_rf"))


def _contact_sql() -> str:
    """The same clean-up by windows: runs are numbered by their changes."""
    w = "(PARTITION BY session_id ORDER BY seq)"
    number = lambda flag, before, name: f"sum(CASE WHEN {flag} = {before} THEN 0 ELSE 1 END) OVER {w} AS {name}"
    out = S + f""", a AS (SELECT session_id, seq, signal * 2 AS l, signal * (phase % 2) AS r, signal * 2 + signal * (phase % 2) AS t, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM s),
b AS (SELECT session_id, seq, n, CASE WHEN t <= 40 THEN 0 ELSE t END AS t, CASE WHEN l <= 20 THEN 0 ELSE l END AS l, CASE WHEN r <= 20 THEN 0 ELSE r END AS r FROM a),
c AS (SELECT *, lag(t <> 0) OVER {w} AS before FROM b), d AS (SELECT *, {number('(t <> 0)', 'before', 'run')} FROM c),
x0 AS (SELECT session_id, seq, n, CASE WHEN t <> 0 AND max(t) OVER (PARTITION BY session_id, run) < 100 THEN 0 ELSE t END AS t, l, r FROM d)"""
    for k, side in enumerate("lr"):
        out += f""", p{k} AS (SELECT *, lag({side} > 0.01) OVER {w} AS before FROM x{k}), q{k} AS (SELECT * EXCLUDE (before), {number(f'({side} > 0.01)', 'before', 'run')} FROM p{k}),
e{k} AS (SELECT *, max(seq) OVER u + 1 - CASE WHEN max(seq) OVER u + 1 = n THEN 1 ELSE 0 END AS stop, min(seq) OVER u AS start FROM q{k} WINDOW u AS (PARTITION BY session_id, run)),
f{k} AS (SELECT * EXCLUDE (run, stop, start), CASE WHEN {side} > 0.01 AND NOT (seq < stop AND (stop - start < 10 OR stop - start < 15 AND max(CASE WHEN seq < stop THEN {side} END) OVER (PARTITION BY session_id, run) < 100)) THEN 1 ELSE 0 END AS i{side} FROM e{k}),
g{k} AS (SELECT *, lag(i{side} = 0) OVER {w} AS before FROM f{k}), h{k} AS (SELECT * EXCLUDE (before), {number(f'(i{side} = 0)', 'before', 'run')} FROM g{k}),
j{k} AS (SELECT *, max(seq) OVER u + 1 - CASE WHEN max(seq) OVER u + 1 = n THEN 1 ELSE 0 END AS stop, min(seq) OVER u AS start FROM h{k} WINDOW u AS (PARTITION BY session_id, run)),
x{k + 1} AS (SELECT * EXCLUDE (run, stop, start, i{side}), CASE WHEN i{side} = 0 AND seq < stop AND stop - start < 5 THEN 1 ELSE i{side} END AS i{side} FROM j{k})"""
    return out + " SELECT session_id, seq, t * 1000 AS grf, l * 1000 AS grf_lf, r * 1000 AS grf_rf, CAST(il AS INTEGER) AS lf_ind, CAST(ir AS INTEGER) AS rf_ind FROM x2"


@query(_contact_sql())
def contact_cleanup(spark, sf_dir):
    """Forces thresholded by weight, weak contacts dropped, gaps bridged."""
    s = _feet(spark, sf_dir).withColumn("grf", F.col("grf_lf") + F.col("grf_rf"))
    return P.clean_force(s, "grf", "grf_lf", "grf_rf", F.lit(200.0)).select("session_id", "seq", "grf", "grf_lf", "grf_rf", "lf_ind", "rf_ind")


@query()
def foot_phases(spark, sf_dir):
    """ground, air, impact and take-off of both feet."""
    s = _feet(spark, sf_dir).withColumns({"lf_ind": (F.col("phase") == 2).cast("int"), "rf_ind": (F.col("phase") == 3).cast("int")})
    return P.phases(s.select("session_id", "seq", "acc_lf_z", "acc_rf_z", "lf_ind", "rf_ind", "acc_hip_x", "acc_hip_z", "total_accel"))


@query()
def step_cmes(spark, sf_dir):
    """Measures of the contacts of each session; none where a sample is flagged."""
    x = F.col("signal")
    s = samples(spark, sf_dir).select("session_id", "seq", "phase", "micros", (F.sin(x) / 3).alias("hip_pitch"), (F.cos(x) / 4).alias("hip_roll"), F.sin(x / 50).alias("hip_yaw"), (F.sin(x / 9) / 2).alias("pitch"), (F.cos(x / 7) / 2).alias("roll"), x.alias("acc_z"), (F.col("event_id") % 97 == 0).cast("int").alias("remove"))

    def run(c):
        on = np.flatnonzero(np.diff(np.concatenate(([0], (c["phase"] != 1).astype(int), [0]))))
        steps = [(int(a), int(b) - 1) for a, b in zip(on[::2], on[1::2]) if b - a >= 6]
        rows = M.step_cmes(c, "LF", steps, c["micros"] // 1000, c["remove"] == 1, np.full(len(c["seq"]), 600.0))
        kinds = {"max_ankle_pitch_time": pa.int64()}
        columns = list(zip(*rows)) or [()] * len(M.CME_COLUMNS)
        return {"session_id": np.full(len(steps), c["session_id"][0]), "start": [a for a, _ in steps], "end": [b for _, b in steps]} | {n: pa.array(v, kinds.get(n, pa.float64())) for n, v in zip(M.CME_COLUMNS, columns)}

    schema = "session_id long, start long, end long, " + ", ".join(f"{n} {'long' if n == 'max_ankle_pitch_time' else 'double'}" for n in M.CME_COLUMNS)
    return G.per_session(s, run, schema)
