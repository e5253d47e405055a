"""Drift of orientation: correction points by the rhythm of the motion, errors spread along the sphere.

A foot is level and still for an instant in each stride, and a hip is upright once a step.
At such points the orientation must not change from stride to stride; what it changes there
is drift, and is taken out in equal parts of the rotation between two points.

One session is one group (see :mod:`stridelake.operators.signal`).  Quaternions are rows
(w, x, y, z), accelerations are in milli-g, ``moving`` is 1 where the sensor moves.

Two things differ from the surveyed rule, where it contradicts itself: a second pause in one
look-ahead turns the motion after it by its own jump only, and whether a window needs a third
pass does not depend on the windows before it.  A session that ends in motion has its last
window closed by its end; one that ends still does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from stridelake.operators.calibrate import conjugate, euler, multiply
from stridelake.operators.signal import butterworth, forward_backward, peaks_above, spectrum

RATE = 100.0


@dataclass(frozen=True)
class Sensor:
    """What the search for correction points needs to know of a sensor."""

    foot: bool
    #: Low-pass of the acceleration (Hz), share of the root of its maximum that a spectral peak needs.
    low_pass: float
    peak_share: float
    #: Divisor of the peak's height for the turning threshold, factor of the period for the distance.
    amplitude: float
    period: float
    #: Points stay between these multiples of the window's mean point.
    least: float
    most: float
    #: Samples of a spectrum, points that a correction needs (more than), samples at a window's end without points.
    window: int = 1024
    points: int = 7
    tail: int = 200


#: Fixed values.
FOOT = Sensor(foot=True, low_pass=11.0, peak_share=2.0, amplitude=4.0, period=0.9, least=1.2, most=0.0)
HIP = Sensor(foot=False, low_pass=3.0, peak_share=0.5, amplitude=3.0, period=1.0, least=0.8, most=1.5)
#: High-pass and highest rhythm (Hz); share of the first maximum that a main peak exceeds; least foot peak; divisor for the hip's.
HIGH_PASS, MOST_RHYTHM, MAIN_SHARE, FOOT_PEAK, HIP_DIVISOR = 0.5, 3.0, 0.95, 1000.0, 2.5
#: Seconds of look-ahead, samples of a short pause, of a rest, degrees that a hip point or a second pass may be off.
AHEAD, SHORT_PAUSE, REST, HIP_JUMP, LEFT_OVER = 5.0, 19, 20, 5.0, 1.0
#: Samples before and after a foot's point that are near it, share of near points that a foot needs, lead of a sure answer.
NEAR_BEFORE, NEAR_AFTER, NEAR_SHARE, NEAR_SURE = 8, 4, 0.30, 10

IDENTITY = np.array([1.0, 0.0, 0.0, 0.0])


def turns(x: np.ndarray, delta: float, moving: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
    """(1 for a peak or -1 for a trough, place, value, sample that tells) of each turn by ``delta``.

    Three states: undecided, rising, falling.  Only moving samples count.  An extreme that is
    reached twice is no turn, but the direction changes after it.
    """
    side, best = 0, {1: 0, -1: 0}
    place, twice = 0, False
    for i in np.flatnonzero(moving[1:]) + 1:
        now = x[i]
        if side == 0:
            side = -1 if now <= x[best[1]] - delta else 1 if now >= x[best[-1]] + delta else 0
            if now > x[best[1]]:
                best[1] = i
            elif now < x[best[-1]]:
                best[-1] = i
            place, twice = i, False
            continue
        ahead = side * (now - x[best[side]])
        if ahead > 0:
            best[side] = place = i
            twice = False
        elif ahead == 0:
            twice = True
        elif ahead <= -delta:
            if not twice:
                yield side, int(place), float(x[place]), int(i)
            side = -side
            best[side] = place = i
            twice = False


def rhythm_points(x: np.ndarray, delta: float, distance: int, moving: np.ndarray, sensor: Sensor = FOOT) -> np.ndarray:
    """Samples after the troughs that follow main peaks (feet), or after main peaks (hips), of one window.

    The first peak must come near the highest value of two periods.  Later ones keep their
    distance to the last peak (and a foot's to its trough) and pass a level; a higher peak
    soon after the last one takes its place, and a trough between the two goes.
    """
    level = FOOT_PEAK if sensor.foot else x.max() / HIP_DIVISOR
    main = MAIN_SHARE * x[: 2 * distance].max()
    reach = distance / 3 if sensor.foot else distance / 2
    peaks: list[tuple[int, float]] = []
    troughs: list[int] = []
    displaced = False
    for side, place, value, told in turns(x, delta, moving):
        if side > 0 and not peaks:
            if value > main:
                peaks.append((place, value))
        elif side > 0:
            apart = abs(peaks[-1][0] - place) >= distance and (not sensor.foot or not troughs or abs(troughs[-1] - place) >= 0.75 * distance)
            if apart and value > level:
                peaks.append((place - 1, value))
            since = (told - peaks[-1][0]) / distance
            if value > peaks[-1][1] and since < 0.9 and (since > 0.2 or not sensor.foot):
                peaks[-1] = (place - 1, value)
                displaced = True
            if displaced and len(peaks) > 1 and len(troughs) > 1:
                before, (a, b) = peaks[-2][0], troughs[-2:]
                if b - a > a - before > 0 and b > before and peaks[-1][0] > b:
                    troughs.pop()
                    displaced = False
        elif peaks and value < 0:
            gap = abs(peaks[-1][0] - place)
            if not troughs:
                if sensor.foot or gap <= reach:
                    troughs.append(place)
            elif abs(troughs[-1] - place) >= distance and 3 <= gap <= reach and peaks[-1][0] > troughs[-1]:
                troughs.append(place - 1)
    return np.array(troughs if sensor.foot else [p for p, _ in peaks], int) + 1


def swing(acceleration: np.ndarray, sensor: Sensor, rate: float = RATE) -> np.ndarray:
    """The filtered acceleration: its size for a foot (rows x, y, z), one axis for a hip."""
    x = np.linalg.norm(acceleration, axis=1) if sensor.foot else np.asarray(acceleration, float)
    for band in ((None, sensor.low_pass), (HIGH_PASS, None)):
        x = forward_backward(*butterworth(1, *band, rate), x, pad=3)
    return x


def fundamental(x: np.ndarray, sensor: Sensor, rate: float = RATE) -> tuple[float, float] | None:
    """(frequency, magnitude) of the first spectral peak that is high enough; none if there is none.

    If it lies above the highest rhythm, half the height is enough.
    """
    frequency, magnitude = spectrum(x, rate)
    height = np.sqrt(max(x.max(), 0.0)) * sensor.peak_share
    found = peaks_above(magnitude, height)
    if len(found) and frequency[found[0]] > MOST_RHYTHM:
        found = peaks_above(magnitude, height / 2)
    return (float(frequency[found[0]]), float(magnitude[found[0]])) if len(found) else None


def correction_points(x: np.ndarray, moving: np.ndarray, begin: int, end: int, sensor: Sensor = FOOT, rate: float = RATE) -> np.ndarray:
    """Points of a moving window, by the rhythm and size of each of its spectra, without outliers."""
    out = [np.zeros(0, int)]
    for at in range(begin, end, sensor.window):
        part = x[at : at + sensor.window]
        first = fundamental(part, sensor, rate) if len(part) == sensor.window else None
        if first is None:
            continue
        delta, distance = round(first[1] * 2 * np.sqrt(2)) / sensor.amplitude, round(rate / first[0] * sensor.period)
        found = at + rhythm_points(part, delta, distance, moving[at : at + sensor.window], sensor)
        found = found[found < len(x)]
        if len(found):
            mean = x[found].mean()
            out.append(found[(sensor.least * mean <= x[found]) & (x[found] <= sensor.most * mean)])
    return np.concatenate(out)


def power(q: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Parts of rotations, on the short way (interpolation from no rotation)."""
    q = np.where(q[..., :1] < 0, -q, q)
    angle = np.arccos(np.clip(q[..., 0], -1, 1))
    size = np.sin(angle)
    axis = q[..., 1:] / np.where(size > 1e-12, size, 1.0)[..., None]
    return np.concatenate((np.cos(share * angle)[..., None], np.sin(share * angle)[..., None] * axis), -1)


def tilt_of(q: np.ndarray) -> np.ndarray:
    """Roll and pitch between two orientations, absolute, in degrees."""
    return np.abs(np.degrees(euler(q)[..., :2]))


def level_part(q: np.ndarray) -> np.ndarray:
    """The rotation that has an orientation's roll and pitch and no yaw."""
    roll, pitch, _ = np.moveaxis(euler(q), -1, 0)
    zero = np.zeros_like(roll)
    return multiply(np.stack((np.cos(pitch / 2), zero, np.sin(pitch / 2), zero), -1), np.stack((np.cos(roll / 2), np.sin(roll / 2), zero, zero), -1))


def changes(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Rotation from each point to the next; the first one starts from no rotation."""
    at = np.concatenate((IDENTITY[None], q[points[1:]]))
    return multiply(conjugate(at[:-1]), at[1:])


def spread(q: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(orientations from the first to the last point with the changes taken out evenly, the changes)."""
    out, drift = q.copy(), changes(q, points)
    for k, (first, last) in enumerate(zip(points[:-1], points[1:])):
        here = np.arange(first, last + 1)
        share = (here - first) / (last - first)
        step = conjugate(power(np.broadcast_to(drift[k], (len(here), 4)), share))
        if k == 0:
            out[here] = multiply(step, q[here])
        else:
            out[here] = multiply(out[first - 1][None], multiply(step, multiply(conjugate(q[first - 1])[None], q[here])))
    return out, drift


def is_left_over(q: np.ndarray, points: np.ndarray, drift: np.ndarray, sensor: Sensor) -> bool:
    """Does any later point lean by over a degree from the one where the correction began?"""
    if len(points) <= sensor.points:
        return False
    since = q[points[sensor.points - 1]]
    for k in range(sensor.points, len(points)):
        if (drift[k - 1] == IDENTITY).any():
            since = q[points[k]]
        elif tilt_of(multiply(conjugate(since), q[points[k]])).max() > LEFT_OVER:
            return True
    return False


def upright_points(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hip points without those that lean from the point before; with the next one, if that leans as well."""
    at, gone = q[points], set()
    for j in range(1, len(points) - 1):
        if tilt_of(multiply(conjugate(at[j - 1]), at[j])).max() > HIP_JUMP:
            gone.add(j)
            if tilt_of(multiply(conjugate(at[j - 1]), at[j + 1])).max() > HIP_JUMP:
                gone.add(j + 1)
    return points[[k for k in range(len(points)) if k not in gone]]


def near(points: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which points lie near one of the marks?"""
    marks = np.sort(marks)
    return np.searchsorted(marks, points + NEAR_BEFORE, "right") > np.searchsorted(marks, points - NEAR_AFTER, "left")


def _short_pause(moving: np.ndarray, end: int, rate: float) -> int:
    """Where motion goes on for good after the pauses that begin at ``end``; 0 if they are no short ones."""
    horizon = min(end + int(AHEAD * rate), len(moving) - 1)
    ahead = moving[end : horizon + 1]
    if not ahead[-1] or (ahead == 0).sum() >= SHORT_PAUSE:
        return 0
    return end + int(np.flatnonzero(np.diff(ahead) == 1)[-1]) + 1


def bridge(q: np.ndarray, ups: np.ndarray, downs: np.ndarray, end: int, resumed: int) -> int:
    """Holds the orientation in the pauses from ``end`` on and lets motion go on from there, in place.

    ``ups`` and ``downs`` are where motions begin and end.  Returns where the motion that
    begins at ``resumed`` ends.
    """
    while end < resumed:
        up = ups[np.searchsorted(ups, end)]
        k = np.searchsorted(downs, up)
        down = int(downs[k]) if k < len(downs) else len(q)
        jump = multiply(q[end - 1], conjugate(q[up - 1]))
        q[end:up] = q[end - 1]
        q[up:down] = multiply(jump[None], q[up:down])
        end = down
    return end


def _rest(moving: np.ndarray, end: int, rate: float) -> int:
    """The sample that completes a rest after ``end``; 0 if none does within the look-ahead."""
    still = np.flatnonzero(moving[end : end + int(AHEAD * rate)] == 0)
    return end + int(still[REST - 1]) if len(still) >= REST else 0


def _settle(out: np.ndarray, q: np.ndarray, moving: np.ndarray, begin: int, end: int, rest: int) -> None:
    """Leads the motion from ``begin`` to ``end`` into the tilt of the rest after it, and holds it until then, in place."""
    edges = np.diff(moving[end : rest + 1])
    ups, downs = (end + np.flatnonzero(edges == d) for d in (1, -1))  # last samples of pauses and of motion between them
    target = IDENTITY
    for pause, motion in zip([*ups[1:], rest][::-1], downs[::-1]):
        target = multiply(multiply(target, q[pause]), conjugate(q[motion]))
    target = multiply(target, q[ups[0]] if len(ups) else q[rest])
    excess = multiply(conjugate(level_part(target)), level_part(out[end - 1]))
    here = np.arange(begin, end)
    share = (here - begin + 1) / max(end - begin - 1, 1)
    out[here] = multiply(out[here], conjugate(power(np.broadcast_to(excess, (len(here), 4)), share)))
    still = end
    for h in range(end, rest + 1):
        if moving[h] == 0:
            out[h], still = out[h - 1], h
        else:
            out[h] = multiply(multiply(out[still], conjugate(q[still])), q[h])


def correct_drift(q: np.ndarray, acceleration: np.ndarray, moving: np.ndarray, sensor: Sensor = FOOT, feet: np.ndarray | None = None, rate: float = RATE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(corrected orientations, candidates, points) of one sensor.

    A window is a stretch of motion of at least the spectrum's length; short pauses in it are
    bridged.  With enough points its drift is spread in two passes, and in a third one if over
    a degree is left; from the last point (or over all of a window without points) it is led
    into the tilt of the rest that follows.  ``feet`` are the left foot's points, for a hip.
    """
    moving = (np.asarray(moving) == 1).astype(int)
    n = len(moving)
    if n <= 3:
        return q.copy(), np.zeros(0, int), np.zeros(0, int)
    x, source, out = swing(acceleration, sensor, rate), q.copy(), q.copy()
    candidates, used = [np.zeros(0, int)], [np.zeros(0, int)]
    begin, bridged = 0, False
    edges = np.diff(moving)
    ups, downs = (np.flatnonzero(edges == d) + 1 for d in (1, -1))
    for i in [*(np.flatnonzero(edges) + 1), *([n] if moving[-1] else [])]:
        if i < n and edges[i - 1] == 1:
            begin = begin if bridged else i
            continue
        if i < n - 1:
            resumed = _short_pause(moving, i, rate)
            bridged = resumed > 0
            if bridged:
                until = bridge(source, ups, downs, i, resumed)
                out[i:until] = source[i:until]
                continue
        length = min(i, n - 1) - begin
        if length < sensor.window or i == n and length == sensor.window:
            continue
        found = correction_points(x, moving, begin, min(i, n - 1), sensor, rate)
        candidates.append(found)
        points = np.zeros(0, int)
        if len(found) > sensor.points:
            points = np.concatenate(([begin], found[(found <= min(i, n - 1) - sensor.tail) & (found > begin)]))
            if not sensor.foot:
                if feet is not None:
                    points = np.concatenate((points[:1], points[1:][near(points[1:], feet[(feet > begin) & (feet < i)])]))
                points = upright_points(source, points)
            if len(points) > 1:
                last, own = points[-1], points - begin
                once, _ = spread(source[begin : last + 1], own)
                part, drift = spread(once, own)
                if is_left_over(part, own, drift, sensor):
                    part, _ = spread(part, own)
                out[begin : last + 1] = part
                out[last + 1 : i] = multiply(out[last][None], multiply(conjugate(source[last])[None], source[last + 1 : i]))
            points = points[1:]
        used.append(points)
        rest = _rest(moving, i, rate) if i < n else 0
        if rest:
            _settle(out, source, moving, int(points[-1]) if len(points) > sensor.points else begin, i, rest)
    return out, np.concatenate(candidates), np.concatenate(used)


def hip_side(candidates: np.ndarray, feet_0: np.ndarray, feet_2: np.ndarray) -> tuple[int | None, bool]:
    """(sensor of the foot that the hip's points follow, is the answer weak?); none if they follow neither."""
    zero, two = (int(near(candidates, f).sum()) for f in (feet_0, feet_2))
    if all(k < NEAR_SHARE * max(len(f), 1) for k, f in ((zero, feet_0), (two, feet_2))):
        return None, True
    return (2 if two > zero else 0), abs(two - zero) < NEAR_SURE


#: Cut-off and order of the slow part, samples whose mean is kept, samples and angle (degrees) of a level start.
SLOW, SLOW_ORDER, KEPT_FROM, KEPT_TO, LEVEL_SAMPLES, LEVEL_ANGLE = 0.1, 3, 100, 150, 25, 10.0


def _about(axis: int, angle: np.ndarray) -> np.ndarray:
    """Rotations by angles about one axis (1: roll, 2: pitch)."""
    out = np.zeros((len(angle), 4))
    out[:, 0], out[:, axis] = np.cos(angle / 2), np.sin(angle / 2)
    return out


def drift_filter(quats: np.ndarray, rate: float = 100.0) -> np.ndarray:
    """Orientations without the slow part of their roll and pitch.

    If the session starts level, the mean of the slow part early in the session is taken for
    the filter's own offset and stays in.  Sessions too short for the filter are left as they are.
    """
    if len(quats) <= 3 * (SLOW_ORDER + 1):
        return quats
    angles = euler(quats)
    slow = forward_backward(*butterworth(SLOW_ORDER, None, SLOW, rate), angles)
    taken = multiply(_about(2, slow[:, 1]), _about(1, slow[:, 0]))
    level = angles[:LEVEL_SAMPLES, :2].mean(0) < np.radians(LEVEL_ANGLE)
    kept = taken[KEPT_FROM:KEPT_TO]
    if level.all() and len(kept):
        mean = kept.mean(0)
        offset = euler((mean / np.linalg.norm(mean))[None])
        taken = multiply(taken, conjugate(multiply(_about(2, offset[:, 1]), _about(1, offset[:, 0]))))
    return multiply(quats, conjugate(taken))
