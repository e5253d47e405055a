"""Heading, still windows and placement votes on built motions."""

import numpy as np
import pytest

from stridelake.operators import calibrate as C


def axis(angle, *v):
    return np.concatenate((np.cos(angle / 2)[:, None], np.sin(angle / 2)[:, None] * np.array(v)), 1)


@pytest.mark.parametrize("degrees", [-40.0, -7.0, 12.0, 60.0])
def test_heading_of_a_march(degrees):
    t = np.linspace(0, 6 * np.pi, 500)
    pitch = np.radians(45) * np.clip(np.sin(t), 0, None)
    h = np.radians(degrees)
    turn = axis(np.full(500, h), 0, 0, 1)
    q = C.multiply(C.multiply(turn, axis(pitch, 0, 1, 0)), C.conjugate(turn))
    assert abs(np.degrees(C.heading(q, 0)) - degrees) < 1.0


def test_no_heading_without_pitch():
    with pytest.raises(C.CalibrationError) as e:
        C.heading(np.tile([1.0, 0, 0, 0], (100, 1)), 2)
    assert (e.value.code, e.value.sensor) == ("HEADING_DETECTION", 2)


def test_last_still_and_march():
    rng = np.random.default_rng(0)
    angle = np.concatenate((np.zeros(80), np.cumsum(rng.normal(size=60)) / 10))
    static = np.ones(140)
    assert C.last_still(axis(angle, 1, 0, 0), static, 0)[1] <= 82
    with pytest.raises(C.CalibrationError):
        C.last_still(axis(np.arange(60) / 5.0, 1, 0, 0), np.ones(60), 0)
    flags = np.concatenate((np.zeros(200), np.ones(300), np.zeros(10), np.ones(500), np.zeros(50)))
    assert C.march_candidates(flags) == [(200, 800)]
    assert C.march_candidates(np.concatenate((np.zeros(100), np.ones(500)))) == []


def test_votes():
    n = 1000
    t = np.arange(n)
    pitch_0, pitch_2 = 30 * (np.sin(t * np.pi / 50) > 0.99) * np.sin(t * np.pi / 50), 30 * (np.sin((t + 50) * np.pi / 50) > 0.99) * np.sin((t + 50) * np.pi / 50)
    acc_0, acc_2 = np.cos(t * np.pi / 50 - 0.3), np.cos((t + 50) * np.pi / 50 - 0.3)
    hip = -9 * np.sin((t - 40) * np.pi / 50)
    order, weak = C.lateral_vote(pitch_0, pitch_2, acc_0, acc_2, hip)
    assert not weak and order in ([0, 1, 2], [2, 1, 0])
    other, _ = C.lateral_vote(pitch_0, pitch_2, acc_0, acc_2, -hip)
    assert other == order[::-1]
    c, a, b = np.zeros(400), np.zeros(400), np.zeros(400)
    c[::20], b[2::20] = 1, 1
    assert C.hip_vote(c, a, b) == ([2, 1, 0], False) and C.hip_vote(c * 0, a, b) == ([0, 0, 0], True)
    assert C.placement(([0, 0, 0], True), ([2, 1, 0], True)) == [2, 1, 0] and C.placement(([0, 1, 2], True), ([2, 1, 0], False)) == [2, 1, 0]
