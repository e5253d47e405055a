"""Calibration from a marching phase: still windows, reference orientation, heading, placement.

One session is one group; kernels are numpy over all samples at once.
"""

from __future__ import annotations

import numpy as np

from stridelake.operators.signal import detect_peaks, peaks_above

#: Static window, its still samples and angle; march length bounds and lead; yaw spread and trim (degrees).
STILL, STILL_LEAST, STILL_ANGLE, MARCH_LEAST, MARCH_MOST, LEAD, YAW_STD, YAW_TRIM, PITCH_LEAST = 25, 20, 0.75, 400, 600, 150, 10.0, 15.0, 20.0


class CalibrationError(Exception):
    """No calibration: ``code`` and, where it applies, the sensor; callers keep them as rows."""

    def __init__(self, code: str, sensor: int | None = None):
        super().__init__(f"{code}, sensor {sensor}")
        self.code, self.sensor = code, sensor


def multiply(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Hamilton product of rows (w, x, y, z)."""
    pw, qw, pv, qv = p[..., :1], q[..., :1], p[..., 1:], q[..., 1:]
    return np.concatenate((pw * qw - (pv * qv).sum(-1, keepdims=True), pw * qv + qw * pv + np.cross(pv, qv)), -1)


def conjugate(q: np.ndarray) -> np.ndarray:
    return q * np.array([1.0, -1, -1, -1])


def euler(q: np.ndarray) -> np.ndarray:
    """Roll, pitch and yaw of unit quaternions, in radians."""
    w, x, y, z = np.moveaxis(q, -1, 0)
    pitch = np.arcsin(2 * np.clip(w * y - x * z, -0.5, 0.5))
    return np.stack((np.arctan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)), pitch, np.arctan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))), -1)


def last_still(quats: np.ndarray, static: np.ndarray, sensor: int) -> tuple[int, int]:
    """The last window (searched backwards) that is flagged still, or turns by under a degree's three quarters."""
    angles = np.degrees(euler(quats)[:, :2])
    for end in range(len(angles) - 1, STILL, -1):
        window = slice(end - STILL, end)
        if (static[window] == 0).sum() >= STILL_LEAST or np.ptp(angles[window], axis=0).max() < STILL_ANGLE:
            return end - STILL, end
    raise CalibrationError("STILL_DETECTION", sensor)


def march_candidates(static: np.ndarray) -> list[tuple[int, int]]:
    """Long moving runs after the lead; static blips under 15 samples do not end a run."""
    moving = static.copy()
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (moving == 0).astype(int), [0]))))
    for a, b in zip(edges[::2], edges[1::2]):
        b = min(b, len(moving) - 1)
        if b - a < 15:
            moving[a:b] = 1
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (moving == 1).astype(int), [0]))))
    found = [(int(a), int(min(b, len(moving) - 1))) for a, b in zip(edges[::2], edges[1::2])]
    return [(a, min(b, a + MARCH_MOST)) for a, b in found if b - a >= MARCH_LEAST and a > LEAD]


def marches(acceleration: np.ndarray) -> bool:
    """Three or more peaks of over 1 g beyond gravity (milli-g), half a second apart."""
    return len(peaks_above(np.linalg.norm(acceleration, axis=1) - 1000, 1000.0, 50)) >= 3


def yaw_and_pitch(delta: np.ndarray, steps: int = 499, rate: float = 0.2) -> tuple[np.ndarray, np.ndarray]:
    """Yaw and pitch angles (radians) that best explain rotations, by gradient descent over all rows.

    A yaw y (a complex number) turns the rotation's axis part d = x + iy to d conj(y)^2; the
    result should have no roll and no yaw, equal the pitch p, and both should have length 1.
    """
    w, d, k = delta[:, 0], delta[:, 1] + 1j * delta[:, 2], delta[:, 3]
    y, p = np.ones(len(w), complex), np.ones(len(w), complex)
    for _ in range(steps):
        size, turned = np.abs(y) ** 2, d * np.conj(y) ** 2
        e_w, e_j, e_p = w * size - p.real, turned.imag - p.imag, np.abs(p) ** 2 - 1
        grad_y = 2 * y * (w * e_w + k * k * size + size - 1) + 2 * d * np.conj(y) * (turned.real - 1j * e_j)
        grad_p = -e_w - 1j * e_j + 2 * p * e_p
        y, p = y - rate * grad_y, p - rate * grad_p
    flip = p.real * p.imag < 0
    yaw = 2 * np.angle(np.where(flip, 1j * y, y))
    pitch = 2 * np.angle(np.where(flip, np.conj(p), p))
    return (yaw + np.pi) % (2 * np.pi) - np.pi, pitch


def heading(march: np.ndarray, sensor: int) -> float:
    """Heading (radians) of a foot from its marching orientations.

    Only samples pitched by over 20 degrees count.  Positive and negative yaws are judged
    apart: spread under 10 degrees, or under it within 15 degrees of the median; the two
    means are weighted by their samples.
    """
    yaw, pitch = yaw_and_pitch(multiply(conjugate(march[:1]), march))
    degrees = np.degrees(yaw[np.degrees(pitch) > PITCH_LEAST])
    parts = []
    for side in (degrees[degrees >= 0], degrees[degrees < 0]):
        if len(side) and side.std() >= YAW_STD:
            side = side[np.abs(side - np.median(side)) < YAW_TRIM]
        if len(side) and side.std() < YAW_STD:
            parts.append((side.mean(), len(side)))
    if not parts:
        raise CalibrationError("HEADING_DETECTION", sensor)
    turns = np.exp(1j * np.radians([m for m, _ in parts]))
    first = np.angle(turns[0])
    rest = np.angle(turns / turns[0])  # the short way between the two means
    return float(first + np.average(rest, weights=[n for _, n in parts]))


def lateral_vote(pitch_0: np.ndarray, pitch_2: np.ndarray, acc_0: np.ndarray, acc_2: np.ndarray, hip: np.ndarray) -> tuple[list[int], bool]:
    """Which foot sensor is left, by the hip's sideways reaction to each step; and is the vote weak?

    A step is a pitch peak of 20 degrees; from its first change of sign of the foot's
    acceleration to that of the next step, the hip's first excursion over 5 is a vote.
    """
    marks = sorted((int(i), s) for s, x in ((0, pitch_0), (2, pitch_2)) for i in detect_peaks(x, 20.0))
    crossings = []
    for n, (i, s) in enumerate(marks):
        part = (acc_0, acc_2)[s == 2][i : marks[n + 1][0] if n + 1 < len(marks) else None]
        turn = np.flatnonzero(np.diff(np.sign(part)))
        if len(turn):
            crossings.append((i + int(turn[0]) + 1, s))
    votes = {0: 0, 2: 0}
    for (a, s), (b, _) in zip(crossings, crossings[1:]):
        low, high = detect_peaks(hip[a:b], 5.0, edge=None, valley=True), detect_peaks(hip[a:b], 5.0, edge=None)
        if len(low) or len(high):
            trough_first = not len(high) or len(low) and low[0] < high[0]
            votes[s if trough_first else 2 - s] += 1
    weak = abs(votes[0] - votes[2]) <= 1 or votes[0] + votes[2] <= 2
    return ([0, 1, 2] if votes[0] > votes[2] else [2, 1, 0] if votes[2] > votes[0] else [0, 0, 0]), weak


def hip_vote(correction: np.ndarray, troughs_0: np.ndarray, troughs_2: np.ndarray, pad: int = 5) -> tuple[list[int], bool]:
    """Which foot's troughs lie near the hip's correction points; weak under 11 more."""
    points = np.flatnonzero(correction == 1)
    if not len(points):
        return [0, 0, 0], True
    near = np.zeros(len(correction) + pad, bool)
    for d in range(-pad, pad):
        near[np.clip(points + d, 0, len(correction) - 1)] = True
    zero, two = (int(t[near[: len(t)]].sum()) for t in (troughs_0, troughs_2))
    return ([2, 1, 0] if two > zero else [0, 0, 0] if two == zero else [0, 1, 2]), abs(two - zero) <= 10


def placement(hip: tuple[list[int], bool], lateral: tuple[list[int], bool]) -> list[int]:
    """The hip's answer if it is sure, else the lateral one, else whichever there is; zeros are a failure."""
    none = [0, 0, 0]
    if not hip[1]:
        return hip[0]
    if not lateral[1]:
        return lateral[0]
    return hip[0] if hip[0] != none else lateral[0]
