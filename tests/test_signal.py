"""Kernels against analytic signals and plain loops."""

import numpy as np
import pytest

from stridelake.operators import signal as G
from stridelake.operators import step_measures as C


def test_butterworth_known_coefficients_and_gain():
    b, a = G.butterworth(1, None, 25.0, 100.0)
    assert np.allclose(b, [0.5, 0.5]) and np.allclose(a, [1, 0], atol=1e-12)
    b, a = G.butterworth(2, None, 25.0, 100.0)
    assert np.allclose(b, [0.29289322, 0.58578644, 0.29289322]) and np.allclose(a, [1, 0, 0.17157288], atol=1e-8)
    for order in (1, 2, 3, 4):
        for low, high in ((None, 6.0), (0.5, 20.0), (2.0, None)):
            b, a = G.butterworth(order, low, high, 97.5)
            for f in (low, high):
                if f is not None:
                    z = np.exp(2j * np.pi * f / 97.5)
                    assert abs(abs(np.polyval(b, z) / np.polyval(a, z)) - 0.70710678) < 1e-6


def test_filter_keeps_and_rejects():
    t = np.arange(1000) / 97.5
    slow, fast = np.sin(2 * np.pi * 1.0 * t), np.sin(2 * np.pi * 30 * t)
    out = G.filter_data(slow + fast, "low", high=6.0)
    assert np.abs(out - slow)[100:-100].max() < 0.02
    assert np.allclose(G.filter_data(np.full(100, 3.0), "low", high=6.0), 3.0)
    both = G.filter_data(np.stack((slow, fast), 1), "low", high=6.0)
    assert np.allclose(both[:, 0], G.filter_data(slow, "low", high=6.0))
    with pytest.raises(ValueError):
        G.filter_data(np.zeros(10), "low")


def test_peaks():
    x = np.array([3, 9, 4, 4, 12, 12, 12, 5, 8, 2, 7, 1], float)
    # Single tops at 1, 8 and 10; a plateau from 4 to 6 counts at its rising end, its falling end, or both.
    assert G.detect_peaks(x).tolist() == [1, 4, 8, 10]
    assert G.detect_peaks(x, edge="falling").tolist() == [1, 6, 8, 10]
    assert G.detect_peaks(x, edge="both").tolist() == [1, 4, 6, 8, 10]
    assert G.detect_peaks(x, edge=None).tolist() == [1, 8, 10]
    assert G.detect_peaks(x, 7.5).tolist() == [1, 4, 8]
    assert G.detect_peaks(x, distance=3).tolist() == [4, 8]
    # Both neighbours must lie lower by the threshold: 9 over 3 and 4, 8 over 5 and 2, 7 over 2 and 1.
    assert G.detect_peaks(x, edge=None, threshold=4).tolist() == [1, 10]
    holed = x.copy()
    holed[9] = np.nan
    assert G.detect_peaks(holed).tolist() == [1, 4]
    assert G.detect_peaks(-x, valley=True).tolist() == [1, 4, 8, 10]
    x = np.array([0, 4, 0, 6, 0, 9, 0, 5, 0, 3, 0, 0], float)
    assert G.peaks_above(np.array([0, 2, 2, 2, 0, 1, 0.0])).tolist() == [2, 5]
    assert G.peaks_above(x, 4.5, 3).tolist() == [5]
    assert G.peaks_above(np.array([0, 5, 0, 4, 0, 3, 0.0]), distance=2).tolist() == [1, 3, 5]


def test_spectrum_finds_the_frequency():
    t = np.arange(1024) / 100
    frequency, magnitude = G.spectrum(np.sin(2 * np.pi * 12.5 * t), 100)
    assert abs(frequency[np.argmax(magnitude)] - 12.5) < 0.1


def test_cadence_zone_of_a_steady_run():
    t = np.arange(3000) / 100
    pitch = np.radians(40) * np.sin(2 * np.pi * 1.25 * t)  # 75 strides, 150 steps a minute
    zones = G.cadence_zones(np.ones(3000), pitch)
    assert set(zones[:2900]) == {20}
    assert not G.cadence_zones(np.zeros(3000), pitch).any()


def test_dickey_fuller_tells_noise_from_a_walk():
    rng = np.random.default_rng(0)
    noise, walk = rng.normal(size=400), rng.normal(size=400).cumsum()
    for y, stationary in ((noise, True), (walk, False)):
        statistic, critical = G.dickey_fuller(y)
        assert abs(critical + 2.869) < 0.01 and (statistic < critical) == stationary
    assert G.dickey_fuller(np.ones(50)) == (-1.0, 0.0) == G.dickey_fuller(np.zeros(2))


def test_step_measures():
    pitch = np.radians(np.concatenate((np.linspace(10, 0, 20), np.linspace(0, 12, 30))))
    rise, rate = C.pelvic_tilt(pitch)
    assert 10 < rise <= 12.0001 and rate > 0
    window = np.radians(np.concatenate((np.linspace(5, -10, 40), np.linspace(-10, 20, 40))))
    span, from_impact, when = C.ankle_range(window, np.arange(80) * 10)
    assert abs(span - 30) < 1e-9 and when == 790 and from_impact < 30
    assert C.ankle_range(np.linspace(20, -20, 80), np.arange(80))[0] is None
    roll = np.radians(np.concatenate((np.linspace(0, 8, 15), np.linspace(8, 0, 25))))
    assert abs(C.hip_drop(roll, "LF") - 8) < 1e-9 and abs(C.hip_drop(-roll, "RF") - 8) < 1e-9 and C.hip_drop(-roll, "LF") is None
    before = roll.copy()
    C.hip_drop(roll, "RF")
    assert (roll == before).all()
    valgus = np.radians(np.array([0, 3, 6, 9, 8, 5, 2, 1, 3, 4.0]))
    assert abs(C.knee_valgus(valgus, np.array([0, 0, 5, 0, 0, 0, 0, 0, 0, 0.0]), "LF") - 8) < 1e-9
    acc = np.zeros(60)
    acc[[5, 45]] = 1
    medial, lateral = C.hip_rotation(0, 40, acc, np.radians(np.where(np.arange(60) < 20, 1.0, -1.0)), "LF", 40)
    assert abs(medial - 15) < 1e-9 and abs(lateral - 25) < 1e-9


def test_filter_holds_one_copy():
    """Both passes of the filter run in place of one padded copy; the input stays."""
    import tracemalloc

    x = np.random.default_rng(9).normal(size=(4000, 30))
    before = x.copy()
    tracemalloc.start()
    G.filter_data(x, "low", high=6.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * x.nbytes and np.array_equal(x, before)
