"""Adaptive points against traced tables and a plain machine; drift that grows is taken out where the foot is level."""

from dataclasses import replace

import numpy as np
import pytest

from stridelake.operators import drift as D
from stridelake.operators.calibrate import conjugate, euler, multiply


def told(x, delta, moving=None):
    return list(D.turns(np.array(x, float), delta, np.ones(len(x), int) if moving is None else np.array(moving)))


@pytest.mark.parametrize(
    ("x", "delta", "moving", "expected"),
    [
        ([0, 5, 1, 6, 2], 3, None, [(1, 1, 5, 2), (-1, 2, 1, 3), (1, 3, 6, 4)]),
        ([0, 5, 3, 5.5, 1], 3, None, [(1, 3, 5.5, 4)]),  # a dip of less than the threshold is no turn
        ([0, 5, 5, 1, 6], 3, None, [(-1, 3, 1, 4)]),  # a peak reached twice tells nothing, but the signal falls after it
        ([0, 5, 5, 6, 2], 3, None, [(1, 3, 6, 4)]),  # a higher value after the plateau counts
        ([0, 5, 1, 1, 5, 1], 3, None, [(1, 1, 5, 2), (1, 4, 5, 5)]),  # the trough's plateau likewise
        ([0, 5, 1, 6, 2], 3, [1, 1, 0, 1, 1], [(1, 3, 6, 4)]),  # what does not move is not there
        ([0, 1, 0, 1], 3, None, []),
        ([5, 4, 1, 5], 3, None, [(-1, 2, 1, 3)]),  # falls from the start
        ([4], 1, None, []),
    ],
)
def test_turns_by_hand(x, delta, moving, expected):
    assert told(x, delta, moving) == expected


def stride(n, period, high, low):
    """Strides of one sharp peak and one trough a fifth of the period later."""
    x = np.zeros(n)
    for a in range(5, n - period, period):
        x[a], x[a + period // 5] = high, low
    return x


def test_points_by_hand():
    distance = 18
    x = stride(200, 20, 3000.0, -1500.0)
    ones = np.ones(200, int)
    # The first trough is told with its own place, later ones one sample before; both then move by one.
    assert D.rhythm_points(x, 700.0, distance, ones).tolist() == [10, *range(29, 170, 20)]
    # A hip's points are its main peaks.
    assert D.rhythm_points(x, 700.0, distance, ones, D.HIP).tolist() == [6, *range(25, 166, 20)]
    # Later peaks of under 1 g are no main peaks, so the troughs after them do not count.
    weak = x.copy()
    weak[25:100][weak[25:100] > 0] = 900.0
    assert D.rhythm_points(weak, 700.0, distance, ones).tolist() == [10, 109, 129, 149, 169]
    # The first peak must come near the highest value of two periods.
    late = x.copy()
    late[5] = 2000.0
    assert D.rhythm_points(late, 700.0, distance, ones).tolist() == [30, *range(49, 170, 20)]
    # A trough above zero is none, and one too far from its peak neither.
    assert D.rhythm_points(np.where(x < 0, 500.0, x + 2000), 700.0, distance, ones).tolist() == []
    far = np.roll(np.where(x < 0, x, 0), 5) + np.where(x > 0, x, 0)
    assert D.rhythm_points(far, 700.0, distance, ones).tolist() == [15]
    # Nothing is found where nothing moves.
    assert D.rhythm_points(x, 700.0, distance, ones * 0).tolist() == []


def test_higher_peak_takes_the_place_of_the_last():
    x = stride(120, 20, 3000.0, -1500.0)
    x[50], x[45] = 4000.0, 3000.0  # five samples after the peak at 45, beyond its trough at 49
    peaks = D.rhythm_points(x, 700.0, 18, np.ones(120, int), D.HIP)
    assert 50 in peaks and 45 not in peaks


def pulses(t, period, trough=0.2):
    """A peak of 4 g at the start of each period, a trough of 2 g a part of it later."""
    phase = (t / period + 0.5) % 1 - 0.5
    return 4000 * np.exp(-((phase / 0.05) ** 2)) - 2000 * np.exp(-(((phase - trough) / 0.05) ** 2))


def test_points_follow_the_rhythm():
    x = pulses(np.arange(4096), 100 / 1.4)
    points = D.correction_points(x, np.ones(4096, int), 0, 4096, replace(D.FOOT, least=2.0))
    gaps = np.diff(points)
    assert len(points) > 45 and abs(np.median(gaps) - 100 / 1.4) <= 2
    assert np.abs((points / (100 / 1.4) - 0.2 + 0.5) % 1 - 0.5).max() < 0.05
    # The mean of the window's points sets limits; the foot's take only deeper ones than 1.2 means, which none is here.
    assert not len(D.correction_points(x, np.ones(4096, int), 0, 4096, replace(D.FOOT, least=0.5)))
    assert not len(D.correction_points(np.zeros(3000), np.ones(3000, int), 0, 3000))
    frequency, _ = D.fundamental(x[:1024], D.FOOT)
    assert abs(frequency - 1.4) < 0.1


def slerp(q, share):
    """Interpolation from no rotation, by the definition."""
    one, q = np.array([1.0, 0, 0, 0]), q / np.linalg.norm(q)
    dot = one @ q
    if abs(dot) >= 1:
        a, b = 1 - share, share
    else:
        angle = np.arccos(abs(dot))
        a, b = np.sin((1 - share) * angle) / np.sin(angle), np.sin(share * angle) / np.sin(angle)
    out = one * a + q * (b if dot >= 0 else -b)
    return out / np.linalg.norm(out)


def times(*qs):
    out = np.array([1.0, 0, 0, 0])
    for q in qs:
        out = multiply(out[None], np.asarray(q)[None])[0]
    return out


def back(q):
    return np.asarray(q) * [1, -1, -1, -1]


def random_walk(n, seed=0):
    rng = np.random.default_rng(seed)
    q = np.empty((n, 4))
    q[0] = 1, 0, 0, 0
    for i in range(1, n):
        step = np.array([1.0, *rng.normal(0, 0.02, 3)])
        q[i] = times(q[i - 1], step / np.linalg.norm(step))
    return q


def test_spread_equals_a_loop_over_samples():
    q, points = random_walk(300), np.array([0, 40, 41, 100, 180, 299])
    expected = q.copy()
    for k in range(1, len(points)):
        first, last = points[k - 1], points[k]
        drift = q[last] if k == 1 else times(back(q[first]), q[last])
        for h in range(first, last + 1):
            step = back(slerp(drift, (h - first) / (last - first)))
            expected[h] = times(step, q[h]) if k == 1 else times(expected[first - 1], step, back(q[first - 1]), q[h])
    out, drift = D.spread(q, points)
    assert np.allclose(out, expected, atol=1e-12)
    assert np.allclose(drift[1:], [times(back(q[a]), q[b]) for a, b in zip(points[1:], points[2:])])


def test_short_pauses_are_bridged():
    q = random_walk(1200, 1)
    moving = np.ones(1200, int)
    moving[300:310] = moving[420:425] = 0
    moving[1100:] = 0
    q[310:] = multiply(np.array([np.cos(0.1), np.sin(0.1), 0, 0])[None], q[310:])  # the sensor jumps in its pause
    out, candidates, points = D.correct_drift(q, np.zeros((1200, 3)), moving)
    assert not len(candidates) and not len(points)
    held = q[299]
    first = times(held, back(q[309]))
    again = times(times(first, q[419]), back(q[424]))
    # What follows a pause goes on from the held orientation; the rest at the end leads back over the whole window.
    plain = q.copy()
    plain[300:310] = held
    for h in range(310, 420):
        plain[h] = times(first, q[h])
    plain[420:425] = plain[419]
    for h in range(425, 1100):
        plain[h] = times(again, q[h])
    source = q.copy()
    ups, downs = np.array([310, 425]), np.array([300, 420, 1100])
    assert D.bridge(source, ups, downs, 300, 425) == 1100
    assert np.allclose(source[:1100], plain[:1100])
    excess = times(back(D.level_part(q[1119])), D.level_part(plain[1099]))
    for h in range(1100):
        assert np.allclose(out[h], times(plain[h], back(slerp(excess, (h + 1) / 1099))), atol=1e-9)
    assert np.allclose(out[1100:1120], out[1099]) and np.allclose(out[1120:], q[1120:])


def test_rest_with_blips_leads_to_its_tilt():
    n = 1400
    q = random_walk(n, 2)
    moving = np.zeros(n, int)
    moving[10:1200] = moving[1205:1208] = moving[1215:1217] = 1
    out = q.copy()
    rest = D._rest(moving, 1200, 100.0)
    assert rest == 1200 + 5 + 3 + 7 + 2 + 7
    D._settle(out, q, moving, 900, 1200, rest)
    target = times(q[rest], back(q[1216]), q[1214], back(q[1207]), q[1204])
    excess = times(back(D.level_part(target)), D.level_part(q[1199]))
    for h in range(900, 1200):
        assert np.allclose(out[h], times(q[h], back(slerp(excess, (h - 899) / 299))))
    last = 1199
    for h in range(1200, rest + 1):
        if moving[h]:
            assert np.allclose(out[h], times(out[last], back(q[last]), q[h]))
        else:
            last = h
            assert np.allclose(out[h], out[h - 1])
    assert np.allclose(out[rest + 1 :], q[rest + 1 :]) and np.allclose(out[:900], q[:900])


def running(n, drift, yaw=0.0):
    """(true, drifting) orientations and accelerations of a running foot that rests at both ends."""
    t = np.arange(n)
    moving = ((t >= 100) & (t < n - 200)).astype(int)
    phase = np.where(moving == 1, 2 * np.pi * ((t - 100) / 72 - 0.2), 0.0)  # level at the troughs
    pitch = np.radians(25) * (1 - np.cos(phase)) * moving
    true = np.stack((np.cos(pitch / 2), 0 * pitch, np.sin(pitch / 2), 0 * pitch), 1)
    lean = np.radians(drift) * np.clip((t - 100) / (n - 300), 0, 1) * (t < n - 190)
    off = np.stack((np.cos(lean / 2), np.sin(lean / 2) * 0.6, np.sin(lean / 2) * 0.8, 0 * lean), 1)
    size = 2500 + moving * pulses(t - 100, 72)
    return true, multiply(off, true), np.stack((size * 0, size * 0, size), 1), moving


def test_growing_drift_is_taken_out():
    true, seen, acc, moving = running(6000, 20.0)
    out, candidates, points = D.correct_drift(seen, acc, moving)
    assert len(points) > 40 and set(points) <= set(candidates)
    tilt = lambda q: np.degrees(2 * np.arccos(np.clip(np.abs(q[..., 0]), 0, 1)))
    before = tilt(multiply(conjugate(seen[points[1:]]), seen[points[:-1]]))
    after = tilt(multiply(conjugate(out[points[1:]]), out[points[:-1]]))
    assert before.mean() > 0.2 and after.max() < 0.05
    # At the points the foot has one orientation, which is level in the end; elsewhere the error stays under a degree of its own swing there.
    error = tilt(multiply(multiply(conjugate(true), out), conjugate(multiply(conjugate(true[points[5]])[None], out[points[5]][None]))))
    assert np.median(error[points[5] : points[-5]]) < 1.0
    assert np.abs(np.degrees(euler(out[5800:5819]))[:, :2]).max() < 1.0
    assert np.allclose(out[:100], seen[:100])


def test_hip_points_and_sides():
    q = random_walk(400, 4)
    lean = np.array([np.cos(np.radians(5)), np.sin(np.radians(5)), 0, 0])
    q[:] = [1, 0, 0, 0]
    q[200] = q[250] = lean
    assert D.upright_points(q, np.array([0, 100, 200, 300])).tolist() == [0, 100, 300]
    q[300] = lean
    assert D.upright_points(q, np.array([0, 100, 200, 300, 350])).tolist() == [0, 100, 350]
    points = np.array([92, 100, 104, 105, 91])
    assert D.near(points, np.array([100])).tolist() == [True, True, True, False, False]
    assert not D.near(points, np.array([], int)).any()
    left, right = np.arange(100, 1000, 50), np.arange(125, 1000, 50)
    assert D.hip_side(left + 2, left, right) == (0, False)
    assert D.hip_side(right[:12], left, right) == (2, False)
    assert D.hip_side(right[:8], left, right) == (2, True)
    assert D.hip_side(np.array([110]), left, right) == (None, True)


def test_short_and_still_sessions_pass():
    for n in (0, 1, 3, 20):
        q = random_walk(max(n, 1), 5)[:n]
        out, candidates, points = D.correct_drift(q, np.zeros((n, 3)), np.zeros(n))
        assert np.array_equal(out, q) and not len(candidates) and not len(points)
    q = random_walk(2000, 6)
    assert np.array_equal(D.correct_drift(q, np.zeros((2000, 3)), np.zeros(2000))[0], q)
