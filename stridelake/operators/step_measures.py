"""Measures of one ground contact, from the arrays of its samples (radians, 10 ms a sample)."""

from __future__ import annotations

import numpy as np

from stridelake.operators.signal import peaks_above


def pelvic_tilt(pitch: np.ndarray) -> tuple[float | None, float | None]:
    """Range (degrees) and rate of the tilt from the dip after the steepest fall to the later top."""
    half = len(pitch) // 2
    top = half + int(np.argmax(pitch[half:]))
    slopes = np.diff(pitch, prepend=pitch[0])[: max(top - 2, 0)]
    if not len(slopes):
        return None, None
    steepest = int(np.argmin(slopes))
    low = steepest + int(np.argmin(pitch[steepest:top]))
    rise = float(np.degrees(pitch[top] - pitch[low]))
    return (rise, rise / (top - low) * 100) if rise >= 0 and top > low else (None, None)


def ankle_range(pitch: np.ndarray, times: np.ndarray, lead: int = 20) -> tuple[float | None, float | None, int | None]:
    """Range from the low of the first half to the high of the second, the range from impact, and the time of the high."""
    half = len(pitch) // 2
    low, high = float(pitch[:half].min()), float(pitch[half:].max())
    at_low, at_high = (int(np.flatnonzero(pitch == v)[0]) for v in (low, high))
    if high < low or at_high - at_low < 15:
        return None, None, None
    return float(np.degrees(high - low)), float(np.degrees(high - pitch[lead])), int(times[at_high])


def hip_drop(roll: np.ndarray, side: str) -> float | None:
    """Rise of the roll from its low in the first six samples to its high before the middle."""
    roll = -roll if side == "RF" else roll
    at = int(np.argmin(roll[:6]))
    ahead = roll[at : max(len(roll) // 2, at + 1)]
    peak = at + int(np.argmax(ahead))
    drop = float(np.degrees(roll[peak] - roll[at]))
    return drop if peak > at and drop > 0 else None


def knee_valgus(roll: np.ndarray, acc_z: np.ndarray, side: str) -> float:
    """Fall from the high of the roll right after impact to its lowest later trough; small ones are 0."""
    roll = -roll if side == "RF" else roll
    impact = int(np.argmax(np.abs(acc_z[:5])))
    peak = impact + int(np.argmax(roll[impact : impact + 6]))
    troughs = peak + peaks_above(-roll[peak:], -30.0)
    if not len(troughs):
        return 0.0
    low = troughs[int(np.argmin(roll[troughs]))]
    fall = float(np.degrees(roll[peak] - roll[low]))
    return fall if low - peak > 2 and fall > 1 else 0.0


def hip_rotation(start: int, end: int, acc_z: np.ndarray, yaw_diff: np.ndarray, side: str, stride: int) -> tuple[float | None, float | None]:
    """Medial rotation up to the middle of the step, lateral rotation up to the next peak."""
    middle = (start + end) // 2
    first = start + int(np.argmax(acc_z[start:middle]))
    ahead = first + stride
    if ahead >= len(acc_z):
        return None, None
    last = ahead - 3 + int(np.argmax(acc_z[ahead - 3 : ahead + 3]))
    sign = 1 if side == "LF" else -1
    early, whole = sign * yaw_diff[first:middle], sign * yaw_diff[first:last]
    return float(np.degrees(early[early > 0].sum())), float(np.degrees(-whole[whole < 0].sum()))


#: Columns of :func:`step_cmes`, null where a rule gives none.
CME_COLUMNS = ("apt_range", "apt_rate", "ankle_pitch_range", "ankle_pitch_range_impact", "max_ankle_pitch_time", "hip_drop", "knee_valgus", "hip_medial", "hip_lateral")


def step_cmes(c: dict[str, np.ndarray], side: str, steps: list[tuple[int, int]], times: np.ndarray, remove: np.ndarray, cadence: np.ndarray) -> list[tuple]:
    """The measures of a side's steps [start, end] of one session.

    ``c`` has hip_pitch, hip_roll, hip_yaw, and the foot's pitch, roll and acc_z, in radians and
    in order.  A step with a flagged sample has no measures; those that need samples before or
    after the step are null at the session's edges.
    """
    n, out = len(c["hip_pitch"]), []
    yaw_diff = np.diff(c["hip_yaw"], prepend=c["hip_yaw"][:1])
    for a, b in steps:
        if remove[a : b + 1].any():
            out.append((None,) * len(CME_COLUMNS))
            continue
        tilt = pelvic_tilt(c["hip_pitch"][a : b + 1])
        ankle = ankle_range(c["pitch"][a - 20 : b + 31], times[a - 20 : b + 31]) if a >= 20 and b < n - 30 else (None, None, None)
        drop = hip_drop(c["hip_roll"][a - 3 : b + 1], side) if a > 3 else None
        valgus = knee_valgus(c["roll"][a : b + 1], c["acc_z"][a : b + 1], side)
        pace = float(np.max(cadence[max(a - 5, 0) : b], initial=0))
        turns = hip_rotation(a, b, c["acc_z"], yaw_diff, side, int(6000 / pace)) if pace > 0 and b > a + 1 else (None, None)
        out.append((*tilt, *ankle, drop, valgus, *turns))
    return out
