"""Direction changes, drift filter, step measures, queue match and guards against plain loops or known signals."""

import random

import numpy as np

from stridelake.operators import joins as J
from stridelake.operators import step_measures as M
from stridelake.operators.calibrate import euler
from stridelake.operators.direction import changes_of_direction
from stridelake.operators.drift import _about, drift_filter


def test_turn_of_a_walk_is_marked():
    t = np.arange(6000) / 97.5
    acc = 3 * np.sin(2 * np.pi * 1.5 * t)
    heading = np.where(np.arange(6000) < 3000, 10.0, 120.0)
    flags = changes_of_direction(acc, heading)
    on = np.flatnonzero(flags)
    assert len(on) and on.min() > 2400 and on.max() < 3800 and flags[2900:3100].all()
    assert not changes_of_direction(acc, np.full(6000, 170.0)).any()
    # Folding: a heading that jumps between +179 and -179 is no change.
    assert not changes_of_direction(acc, np.where(np.arange(6000) % 200 < 100, 179.0, -179.0)).any()
    assert not changes_of_direction(acc[:10], heading[:10]).any()


def test_drift_filter_takes_the_slow_part_out():
    t = np.arange(4000) / 100
    fast, slow = 0.2 * np.sin(2 * np.pi * 1.0 * t), 0.3 * t / t[-1]
    out = euler(drift_filter(_about(2, fast + slow)))[:, 1]
    assert np.abs(out[500:-500] - fast[500:-500]).max() < 0.05
    short = _about(1, np.zeros(10))
    assert (drift_filter(short) == short).all()


def test_step_measures_of_a_known_step():
    n = 300
    grow = np.clip((np.arange(n) - 100) / 60, 0, 1)
    c = {
        "hip_pitch": np.where(np.arange(n) < 130, 0.3 - 0.01 * np.abs(np.arange(n) - 100), 0.1 * grow), "hip_roll": 0.02 * grow, "hip_yaw": np.radians(np.arange(n) % 50),
        "pitch": -0.5 + grow, "roll": np.zeros(n), "acc_z": np.where(np.arange(n) % 60 == 40, 9.0, 0.0),
    }
    (row,) = M.step_cmes(c, "LF", [(100, 160)], np.arange(n) * 10, np.zeros(n, bool), np.full(n, 100.0))
    found = dict(zip(M.CME_COLUMNS, row))
    assert found["ankle_pitch_range"] is not None and abs(found["ankle_pitch_range"] - np.degrees(1.0)) < 1e-6
    assert found["knee_valgus"] == 0.0 and found["hip_medial"] is not None
    removed = np.zeros(n, bool)
    removed[120] = True
    assert M.step_cmes(c, "LF", [(100, 160), (2, 40)], np.arange(n) * 10, removed, np.zeros(n))[0] == (None,) * 9
    edge = dict(zip(M.CME_COLUMNS, M.step_cmes(c, "RF", [(2, 40)], np.arange(n) * 10, np.zeros(n, bool), np.zeros(n))[0]))
    assert edge["ankle_pitch_range"] is None and edge["hip_drop"] is None and edge["hip_medial"] is None


def test_queue_match_equals_a_loop(spark):
    rng = random.Random(3)
    ranges, points, expected = [], [], []
    for session in range(20):
        own = sorted({rng.randint(0, 80) for _ in range(rng.randint(0, 12))})
        own = [(a, a + rng.randint(0, 15)) for a in own]
        queue = sorted({rng.randint(0, 90) for _ in range(rng.randint(0, 15))})
        ranges += [(session, a, b) for a, b in own]
        points += [(session, t, float(t)) for t in queue]
        for a, b in own:
            while queue and queue[0] < a:
                queue.pop(0)
            if queue and queue[0] <= b:
                expected.append((session, a, b, queue[0], float(queue.pop(0))))
    got = J.queue_match(spark.createDataFrame(ranges, "session_id long, start long, end long"), spark.createDataFrame(points, "session_id long, at long, pitch double"))
    assert sorted(map(tuple, got.collect())) == sorted(expected)
