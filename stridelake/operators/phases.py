"""Contact clean-up, foot phases and stances of a session.

Relational parts are windows over one sort; filters and the refinement of impacts, which
look at whole runs of samples, are numpy inside one grouped Arrow function.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators.ranges import KEY, SEQ, by_seq, fill_short_runs, with_runs
from stridelake.operators.signal import filter_data, per_session
from stridelake.operators.windows import forward_fill

#: Phases of a foot.
GROUND, AIR, IMPACT, TAKEOFF = 0, 1, 2, 3
#: Fixed value: samples of a deviation.
DEVIATION = 100


def standing(df: DataFrame, pitch: str, low: float = -np.pi / 4, high: float = np.pi / 2, longer: int = 50, bridge: int = 200, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Adds ``standing``: pitch inside [low, high] in runs over ``longer`` samples, gaps under ``bridge`` filled."""
    inside = df.withColumn("standing", F.coalesce(F.col(pitch).between(low, high), F.lit(False)).cast("int"))
    kept = fill_short_runs(inside, "standing", 1, longer + 1, 0, "exact", key, seq)
    return fill_short_runs(kept, "standing", 0, bridge, 1, "exact", key, seq)


def low_passed(df: DataFrame, columns: list[str], high: float = 18.0, rate: float = 97.5, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """``df`` with columns through a zero-phase low-pass over the samples that have all of them; sessions of 15 such samples or fewer stay as they are."""
    kinds = dict(df.dtypes)

    def run(c: dict) -> dict:
        x = np.stack([c[n] for n in columns], 1)
        y = filter_data(x, "low", high=high, rate=rate) if len(x) > 15 else x
        return {key: c[key], seq: c[seq], **{n: y[:, i] for i, n in enumerate(columns)}}

    known = df.select(key, seq, *(F.col(c).cast("double").alias(c) for c in columns)).dropna(subset=columns)
    filtered = per_session(known, run, f"{key} {kinds[key]}, {seq} {kinds[seq]}, " + ", ".join(f"{c} double" for c in columns), key, seq)
    return df.drop(*columns).join(filtered, [key, seq], "left").select(*df.columns)


def clean_force(df: DataFrame, total: str, left: str, right: str, mass: Column, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Thresholds force by weight, fills gaps forwards and marks contacts (``lf_ind``, ``rf_ind``).

    Runs of the total that never reach half the weight become 0.  A side's contacts shorter
    than 10 samples go, and those under 15 that stay below half the weight; gaps under 5
    samples are bridged.  Forces are filtered before; nulls before the first value stay.
    """
    w = mass
    out = df
    for c, share in ((total, 0.2), (left, 0.1), (right, 0.1)):
        out = out.withColumn(c, forward_fill(F.when(F.col(c) <= share * w, F.lit(0.0)).otherwise(F.col(c)), key, seq))
    runs = with_runs(out, F.col(total) != 0, key, seq)
    low = F.max(total).over(Window.partitionBy(key, "_run")) < 0.5 * w
    out = runs.withColumn(total, F.when(F.col("_flag") & low, F.lit(0.0)).otherwise(F.col(total))).drop("_flag", "_run")
    n = F.max(seq).over(Window.partitionBy(key)) + 1
    for c, ind in ((left, "lf_ind"), (right, "rf_ind")):
        runs = with_runs(out, F.col(c) > 0.01, key, seq)
        run = Window.partitionBy(key, "_run")
        end = F.max(seq).over(run) + 1
        end = F.when(end == n, n - 1).otherwise(end)
        size = end - F.min(seq).over(run)
        weak = (size < 10) | ((size < 15) & (F.max(F.when(F.col(seq) < end, F.col(c))).over(run) < 0.5 * w))
        out = runs.withColumn(ind, (F.col("_flag") & ~((F.col(seq) < end) & weak)).cast("int")).drop("_flag", "_run")
        out = fill_short_runs(out, ind, 0, 5, 1, "drop_last", key, seq)
    return out.withColumns({c: F.col(c) * 1000 for c in (total, left, right)})


def foot_phase(acc_z: np.ndarray, contact: np.ndarray, hip_x: np.ndarray, hip_z: np.ndarray, hip: np.ndarray, rate: float = 97.5) -> np.ndarray:
    """Ground, air, impact and take-off of one foot.

    A foot moves where the deviation of 100 samples reaches 1.5; the first and last 0.3 s of
    a movement count as ground.  A contact that starts in the air is an impact: its start is
    moved to the hip's trough (or between trough and upward crossing, if they are near) and
    its end to the late maximum of the hip.  The second half of an impact that leads to the
    air is take-off.  A session of under 100 samples is all ground.
    """
    n = len(acc_z)
    if n < DEVIATION:  # nothing moves without one deviation, and 15 samples are too few for the filters
        return np.zeros(n, int)
    return _foot(filter_data(acc_z, "low", high=12, rate=rate), contact, lambda: _hips(hip_x, hip_z, hip, rate), rate)


def _hips(hip_x: np.ndarray, hip_z: np.ndarray, hip: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return filter_data(hip_x, "low", high=40, rate=rate), filter_data(hip_z, "low", high=6, rate=rate), filter_data(hip, "low", high=15, rate=rate)


def _foot(smooth: np.ndarray, contact: np.ndarray, hips, rate: float) -> np.ndarray:
    """The phases of a foot from its filtered acceleration; the hip's filters run only where it moves."""
    n = len(smooth)
    moving = np.zeros(n, bool)
    spread = np.lib.stride_tricks.sliding_window_view(smooth, DEVIATION).std(1, ddof=1)
    moving[DEVIATION // 2 : DEVIATION // 2 + len(spread)] = spread >= 1.5
    edges = np.flatnonzero(np.diff(np.concatenate(([0], moving.astype(int), [0]))))
    spans = list(zip(edges[::2], edges[1::2]))
    phase = moving.astype(int)
    if not spans:
        return phase
    margin = int(0.30 * rate)
    for a, b in spans:
        phase[a : a + margin] = GROUND
        phase[max(b - margin, 0) : b] = GROUND
    hip_x, hip_z, hip = hips()
    shortest, least = int(0.16 * rate), int(0.1 * rate)
    for a, b in spans:
        if b - a < shortest:
            phase[a:b] = GROUND
            continue
        on = np.flatnonzero(np.diff(np.concatenate(([0], (contact[a:b] > 0).astype(int), [0]))))
        for begin, end in zip(on[::2] + a, on[1::2] + a):
            end = end - 1 if end == b else end
            if begin == a or end <= begin or phase[begin - 1] != AIR:
                continue
            if end - begin < 50:
                begin, end = _refined(begin, end, hip_x, hip_z, hip)
            if end - begin > least:
                phase[begin:end] = IMPACT
    runs = np.flatnonzero(np.diff(np.concatenate(([0], (phase == IMPACT).astype(int), [0]))))
    for begin, end in zip(runs[::2], runs[1::2]):
        if end < n and phase[end] == AIR:
            phase[end - (end - begin) // 2 : end] = TAKEOFF
    return phase


def _refined(begin: int, end: int, hip_x: np.ndarray, hip_z: np.ndarray, hip: np.ndarray) -> tuple[int, int]:
    trough = begin + int(np.argmin(hip_x[begin:end]))
    inner = hip_z[begin : end - 1]
    up = np.flatnonzero((inner[1:] >= 0) & (inner[:-1] < 0)) + 1
    start = trough
    if len(up) and abs(begin + up[0] - trough) <= 10:
        start = (begin + int(up[0]) + trough) // 2
    window = hip[start : end + 5]
    late = 3 * len(window) // 4
    return start, start + late + int(np.argmax(window[late:]))


def phases(df: DataFrame, rate: float = 97.5, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """``phase_lf, phase_rf`` from acc_lf_z, acc_rf_z, lf_ind, rf_ind, acc_hip_x, acc_hip_z and total_accel."""
    from stridelake.operators.signal import per_session

    def run(c):
        n = len(c[seq])
        if n < DEVIATION:
            return {key: c[key], seq: c[seq], **{f"phase_{s}": np.zeros(n, int) for s in ("lf", "rf")}}
        # One pass filters both feet; the hip is filtered once, if one of them moves.
        smooth = filter_data(np.stack([c["acc_lf_z"], c["acc_rf_z"]], 1), "low", high=12, rate=rate)
        hips = cache(lambda: _hips(c["acc_hip_x"], c["acc_hip_z"], c["total_accel"], rate))
        feet = {f"phase_{s}": _foot(smooth[:, i], c[f"{s}_ind"], hips, rate) for i, s in enumerate(("lf", "rf"))}
        return {key: c[key], seq: c[seq], **feet}

    kind = dict(df.dtypes)[key]
    return per_session(df, run, f"{key} {kind}, {seq} long, phase_lf long, phase_rf long", key, seq)


def stance(df: DataFrame, left: str, right: str, not_standing: Column, accel: Column, rate: int, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Adds ``stance``: 0 none, 1 air, 2 single and 3 double dynamic, 4 single and 5 double static.

    A foot balances on the ground while the other does not; balance for over half a second
    without acceleration is static, and short gaps in it are bridged.  Impacts or take-offs
    of both feet within 0.03 s of each other are double.  Later rules win.
    """
    half, pad = int(0.5 * rate), int(0.03 * rate)
    l, r = F.col(left), F.col(right)  # noqa: E741
    both_air = (l == AIR) & (r == AIR)
    out = df.withColumn("_hot", accel > 2.5).withColumn("_down", not_standing)
    balance = {"_lb": (l == GROUND) & (r != GROUND), "_rb": (r == GROUND) & (l != GROUND), "_db": (l == GROUND) & (r == GROUND)}
    for name, is_on in balance.items():
        runs = with_runs(out, is_on, key, seq)
        size = F.count("*").over(Window.partitionBy(key, "_run"))
        static = F.col("_flag") & (size > half) & ~F.col("_hot")
        out = runs.withColumn(name, static.cast("int")).drop("_flag", "_run")
    # Both feet static at once is impossible by definition of the balances, so only long double balance counts.
    for name in balance:
        out = fill_short_runs(out, name, 0, half, 1, "drop_last", key, seq)
    for name, phase in (("_di", IMPACT), ("_dt", TAKEOFF)):
        near = _near_other(out, l == phase, r == phase, pad, key, seq)
        out = near.withColumnRenamed("_double", name)
    single = (F.col("_lb") == 1) | (F.col("_rb") == 1)
    code = (
        F.when(both_air, 1)
        .when(F.col("_down"), 0)
        .when(F.col("_di") | F.col("_dt"), 3)
        .when(l.isin(IMPACT, TAKEOFF) | r.isin(IMPACT, TAKEOFF), 2)
        .when(F.col("_db") == 1, 5)
        .when(balance["_db"], 3)
        .when(single, 4)
        .when(balance["_lb"] | balance["_rb"], 2)
        .otherwise(0)
    )
    return out.withColumn("stance", code).drop("_hot", "_down", "_lb", "_rb", "_db", "_di", "_dt")


def _near_other(df: DataFrame, left: Column, right: Column, pad: int, key: str, seq: str) -> DataFrame:
    """Marks runs of either foot that a run of the other overlaps when padded.

    A right run counts if both are padded, a left run if the right one is.  Overlap means
    that some sample of the other run is at most twice the pad (or the pad) away, so a
    window over the marks answers it without a join.
    """
    near = lambda p: by_seq(key, seq).rowsBetween(-p, p)
    out = df.withColumn("_l", left.cast("int")).withColumn("_r", right.cast("int"))
    out = out.withColumn("_nl", F.max("_l").over(near(2 * pad))).withColumn("_nr", F.max("_r").over(near(pad)))
    marks = []
    for own, other in (("_l", "_nr"), ("_r", "_nl")):
        runs = with_runs(out, F.col(own) == 1, key, seq)
        name = f"_m{own}"
        out = runs.withColumn(name, F.col("_flag") & (F.max(other).over(Window.partitionBy(key, "_run")) == 1)).drop("_flag", "_run")
        marks.append(F.col(name))
    return out.withColumn("_double", marks[0] | marks[1]).drop("_l", "_r", "_nl", "_nr", "_m_l", "_m_r")


def movement_planes(df: DataFrame, lateral: Column, vertical: Column, horizontal: Column, rotation: Column) -> DataFrame:
    """Shares of acceleration by plane, and a flag for each that dominates."""
    total = lateral + vertical + horizontal
    share = lambda c: F.when(total > 0, c / total).otherwise(0.0)
    return df.withColumns({
        "lateral": (share(lateral) > 0.2).cast("int"), "vertical": (share(vertical) > 0.75).cast("int"), "horizontal": (share(horizontal) > 0.2).cast("int"),
        "rotational": (rotation > 0.15).cast("int"), "stationary": (total == 0).cast("int"),
    })
