"""One session end to end: decoded samples to calibrated motion, contacts, phases, blocks and steps.

Every stage is a DataFrame by (session_id, seq).  Sessions that cannot be calibrated end in
a table of failures, not in an exception.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators import phases as P
from stridelake.operators import ranges as R
from stridelake.operators.calibrate import CalibrationError, conjugate, euler, heading, last_still, march_candidates, marches, multiply
from stridelake.operators.drift import FOOT, HIP, correct_drift, hip_side
from stridelake.operators.signal import filter_data, peaks_above, per_session
from stridelake.operators.step_measures import CME_COLUMNS, step_cmes

SENSORS, SIDES = (0, 1, 2), ("lf", "hip", "rf")
G = 9.80665
MOTION = [f"{kind}_{s}_{c}" for s in SIDES for kind, cs in (("acc", "xyz"), ("euler", "xyz")) for c in cs] + ["total_accel", "moving"]
CALIBRATED = "session_id {kind}, seq long, epoch_ms long, " + ", ".join(f"{c} double" for c in MOTION) + ", failure string"


def _arrays(c: dict, sensor: int) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([c[f"quat_{sensor}_{x}"] for x in "wxyz"], 1), np.stack([c[f"acc_{sensor}_{x}"] for x in "xyz"], 1)


def references(c: dict) -> tuple[list[np.ndarray], list[float]]:
    """Reference orientations and headings of the three sensors, from the first valid march."""
    quats, accs = zip(*(_arrays(c, s) for s in SENSORS))
    for sensor in (0, 2):
        for a, b in march_candidates(c[f"static_{sensor}"]):
            if not (marches(accs[0][a : b + 1]) and marches(accs[2][a : b + 1])):
                continue
            lead = max(a - 250, 0)
            try:
                still = {s: last_still(quats[s][lead:a], c[f"static_{s}"][lead:a], s) for s in (0, 2)}
                still[1] = still[0]
                refs = [np.nanmean(quats[s][lead + still[s][0] : lead + still[s][1] + 1], 0) for s in SENSORS]
                refs = [r / np.linalg.norm(r) for r in refs]
                body = [multiply(q, conjugate(r)) for q, r in zip(quats, refs)]
                turns = [heading(body[s][a:b], s) for s in (0, 2)]
            except CalibrationError:
                continue
            if all(_pitches(body[s][a:b], h) for s, h in zip((0, 2), turns)):
                x = multiply(multiply(refs[1][None], np.array([[0.0, 1, 0, 0]])), conjugate(refs[1])[None])[0]
                return refs, [turns[0], float(np.arctan2(x[2], x[1]) - np.pi), turns[1]]
    raise CalibrationError("MARCH_DETECTION")


def _turn(q: np.ndarray, h: float) -> np.ndarray:
    half = np.array([np.cos(h / 2), 0, 0, np.sin(h / 2)])
    return multiply(multiply(conjugate(half)[None], q), half[None])


def _pitches(q: np.ndarray, h: float) -> bool:
    pitch = np.degrees(euler(_turn(q, h))[:, 1])
    return len(peaks_above(pitch - pitch[0], 20.0, 50)) >= 3


def levelled(quats: dict[int, np.ndarray], acc: dict[int, np.ndarray], hip: np.ndarray, moving: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Orientations without drift (F7): both feet, then the hip by the points of the foot that its own points follow."""
    feet = {s: correct_drift(quats[s], acc[s], moving[s], FOOT) for s in (0, 2)}
    fixed, candidates, _ = correct_drift(quats[1], hip, moving[1], HIP, feet[0][2])
    if hip_side(candidates, feet[0][2], feet[2][2])[0] == 2:
        fixed, _, _ = correct_drift(quats[1], hip, moving[1], HIP, feet[2][2])
    return {0: feet[0][0], 1: fixed, 2: feet[2][0]}


def _calibrate(c: dict) -> dict:
    n = len(c["seq"])
    try:
        refs, turns = references(c)
    except CalibrationError as e:
        row = {k: c[k][:1] for k in ("session_id", "seq", "epoch_ms")}
        return row | {k: np.full(1, np.nan) for k in MOTION} | {"failure": [e.code]}
    out = {k: c[k] for k in ("session_id", "seq", "epoch_ms")}
    turned, bodies = {}, {}
    for s in SENSORS:
        q, acc = _arrays(c, s)
        turned[s] = _turn(multiply(q, conjugate(refs[s])[None]), turns[s])
        bodies[s] = multiply(multiply(refs[s][None], np.concatenate((np.zeros((n, 1)), acc), 1)), conjugate(refs[s])[None])
    fixed = levelled(turned, {s: b[:, 1:] for s, b in bodies.items()}, _turn(bodies[1], turns[1])[:, 2], {s: c[f"static_{s}"] for s in SENSORS})
    total = None
    for s, side in zip(SENSORS, SIDES):
        q, body = fixed[s], bodies[s]
        world = multiply(multiply(q, body), conjugate(q))[:, 1:] - np.array([0, 0, 1000.0])
        world *= G / 1000
        angles = euler(q)
        for i, x in enumerate("xyz"):
            out[f"acc_{side}_{x}"], out[f"euler_{side}_{x}"] = world[:, i], angles[:, i]
        if side == "hip":
            total = np.linalg.norm(world, axis=1)
    out["total_accel"] = total
    out["moving"] = (filter_data(total, "low", high=1.0) >= 2.5).astype(float) if n > 15 else np.zeros(n)
    return out | {"failure": pa.nulls(n, pa.string())}


def calibrate(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(motion samples, failures) of decoded sessions."""
    kind = dict(decoded.dtypes)["session_id"]
    columns = ["session_id", "seq", "epoch_ms"] + [c for s in SENSORS for c in (f"static_{s}", *(f"acc_{s}_{x}" for x in "xyz"), *(f"quat_{s}_{x}" for x in "wxyz"))]
    done = per_session(decoded.select(*columns), _calibrate, CALIBRATED.format(kind=kind))
    failures = done.where("failure IS NOT NULL").select("session_id", F.lit("transformandplacement").alias("stage"), F.col("failure").alias("code"))
    return done.where("failure IS NULL").drop("failure"), failures


def linear_force(side: str) -> Column:
    """A documented stand-in for the missing force model: a share of weight by the foot's own motion."""
    return F.greatest((F.col("acc_hip_z") + G) / G, F.lit(0.0)) * F.when(F.abs(f"acc_{side}_z") < 3.0, 1.0).otherwise(0.0)


def contacts(motion: DataFrame, mass: float = 70.0, force=linear_force) -> DataFrame:
    """Activity, forces and contacts of each sample."""
    active = motion.withColumn("active", F.col("moving").cast("int"))
    active = R.fill_short_runs(R.fill_short_runs(active, "active", 0, 100, 1), "active", 1, 1000, 0)
    weight = F.lit(mass * G)
    forced = active.withColumns({"grf_lf": force("lf") * weight, "grf_rf": force("rf") * weight})
    return P.clean_force(forced.withColumn("grf", F.col("grf_lf") + F.col("grf_rf")), "grf", "grf_lf", "grf_rf", weight)


def staged(contact: DataFrame, rate: int = 100) -> DataFrame:
    """Phases and stances joined to the samples (F13, F14); cut once, since kernels ran."""
    found = P.phases(contact.select("session_id", "seq", "acc_lf_z", "acc_rf_z", "lf_ind", "rf_ind", "acc_hip_x", "acc_hip_z", "total_accel"))
    joined = P.standing(contact.join(found, ["session_id", "seq"]), "euler_hip_y")
    return P.stance(joined, "phase_lf", "phase_rf", F.col("standing") == 0, F.col("total_accel"), rate)


def steps(samples: DataFrame) -> DataFrame:
    """Contacts of 0.1 to 1.5 s of either foot in active motion, with their measures."""
    out = None
    for side in ("lf", "rf"):
        found = R.ranges(samples, (F.col(f"phase_{side}") >= 2) & (F.col("active") == 1), "drop_last").where("length BETWEEN 10 AND 150")
        found = found.withColumn("side", F.lit(side.upper())).withColumn("grf_column", F.lit(f"grf_{side}"))
        out = found if out is None else out.unionByName(found)
    marks = out.select("session_id", "side", "start", "end", F.explode(F.sequence("start", F.col("end") - 1)).alias("seq"))
    met = marks.join(samples.select("session_id", "seq", "epoch_ms", "grf_lf", "grf_rf", "acc_hip_z", "total_accel", "euler_hip_y"), ["session_id", "seq"])
    force = F.when(F.col("side") == "LF", F.col("grf_lf")).otherwise(F.col("grf_rf"))
    found = met.groupBy("session_id", "side", "start", "end").agg(
        F.min("epoch_ms").alias("start_ms"), (F.count("*") * 10).alias("duration_ms"), F.sum(force).alias("total_grf"), F.max(force).alias("peak_grf"), F.sum("total_accel").alias("total_accel"),
        F.max("acc_hip_z").alias("peak_hip_accel"), F.percentile("acc_hip_z", F.lit(0.95)).alias("peak_hip_accel_95"), ((F.max("euler_hip_y") - F.min("euler_hip_y")) * 180 / np.pi).alias("pelvic_range"),
    )
    return measured(samples, found)


def measured(samples: DataFrame, step: DataFrame) -> DataFrame:
    """``step`` with the measures of motion (C1-C6) of each step; one session's samples and steps are one group."""
    kind = dict(step.dtypes)["session_id"]
    columns = ("euler_hip_y", "euler_hip_x", "euler_hip_z", *(f"{c}_{s}_{x}" for s in ("lf", "rf") for c, x in (("euler", "y"), ("euler", "x"), ("acc", "z"))))
    flag = F.col("remove") if "remove" in samples.columns else F.lit(0)
    own = samples.select(F.col("session_id").alias("session_id"), "seq", "epoch_ms", flag.alias("remove"), *columns)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("seq")
        c = {n: left.column(n).to_numpy() for n in left.column_names if n != "session_id"}
        rows: list[tuple] = []
        for side in ("LF", "RF"):
            foot = side.lower()
            where = sorted((a, b) for a, b, s in zip(*(right.column(n).to_pylist() for n in ("start", "end", "side"))) if s == side)
            if not where or not len(left):
                continue
            pace = np.zeros(len(left))  # strides a minute, from the distance to the side's next step
            for (a, b), (following, _) in zip(where, where[1:]):
                pace[a:b] = 6000 / (following - a)
            parts = {"hip_pitch": c["euler_hip_y"], "hip_roll": c["euler_hip_x"], "hip_yaw": c["euler_hip_z"], "pitch": c[f"euler_{foot}_y"], "roll": c[f"euler_{foot}_x"], "acc_z": c[f"acc_{foot}_z"]}
            found = step_cmes(parts, side, [(a, b - 1) for a, b in where], c["epoch_ms"], c["remove"] == 1, pace)
            rows += [(right.column("session_id")[0].as_py(), side, a, *m) for (a, _), m in zip(where, found)]
        columns_ = list(zip(*rows)) or [()] * (3 + len(CME_COLUMNS))
        types = [right.schema.field("session_id").type, pa.string(), pa.int64(), *(pa.int64() if n == "max_ankle_pitch_time" else pa.float64() for n in CME_COLUMNS)]
        return pa.table([pa.array(v, t) for v, t in zip(columns_, types)], names=["session_id", "side", "start", *CME_COLUMNS])

    schema = f"session_id {kind}, side string, start long, " + ", ".join(f"{n} {'long' if n == 'max_ankle_pitch_time' else 'double'}" for n in CME_COLUMNS)
    contacts_ = step.select(*(F.col(c).alias(c) for c in ("session_id", "side", "start", "end")))
    found = own.groupBy("session_id").cogroup(contacts_.groupBy("session_id")).applyInArrow(run, schema)
    return step.join(found, ["session_id", "side", "start"], "left")


def blocks(samples: DataFrame) -> DataFrame:
    """Active blocks (gaps of up to ten seconds merge) with their measures."""
    found = R.merge_ranges(R.ranges(samples, F.col("active") == 1, "drop_last"), 1000)
    w = Window.partitionBy("session_id").orderBy("seq", "kind")
    starts = found.select("session_id", F.col("start").alias("seq"), F.lit(0).alias("kind"), "block", F.col("end").alias("stop"))
    both = samples.select("session_id", "seq", F.lit(1).alias("kind"), "epoch_ms", "active", "grf", "grf_lf", "grf_rf", "total_accel").unionByName(starts, allowMissingColumns=True)
    placed = both.withColumn("block", F.last("block", True).over(w)).withColumn("stop", F.last("stop", True).over(w)).where("kind = 1 AND seq < stop")
    on = lambda c: F.sum(F.when(F.col("active") == 1, F.col(c)))
    return placed.groupBy("session_id", "block").agg(F.min("epoch_ms").alias("start_ms"), F.max("epoch_ms").alias("end_ms"), on("grf").alias("total_grf"), on("grf_lf").alias("left_grf"), on("grf_rf").alias("right_grf"), on("total_accel").alias("total_accel"))


def nested(block: DataFrame, step: DataFrame) -> DataFrame:
    """Blocks with their steps of either side as nested arrays, one document a block."""
    body = F.struct(*(c for c in step.columns if c != "session_id"))
    # Blocks of a session do not overlap, so the last one that begins before a step is the only one that can hold it:
    # one window over both, no pairs.
    own = step.select("session_id", "side", F.col("start_ms").alias("at"), F.lit(1).alias("kind"), body.alias("body"))
    begun = block.select("session_id", F.col("start_ms").alias("at"), F.lit(0).alias("kind"), "block", F.col("end_ms").alias("_b"))
    w = Window.partitionBy("session_id").orderBy("at", "kind")
    placed = own.unionByName(begun, allowMissingColumns=True).withColumns({c: F.last(c, True).over(w) for c in ("block", "_b")})
    inside = placed.where("kind = 1 AND block IS NOT NULL AND at <= _b")
    sides = inside.groupBy("session_id", "block").agg(*(F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("body")))).alias(f"steps_{s.lower()}") for s in ("LF", "RF")))
    return block.join(sides, ["session_id", "block"], "left")
