"""Phases, contacts and stances on built sessions and against plain loops."""

import random

import numpy as np
from pyspark.sql import functions as F

from stridelake.operators import phases as P


def test_foot_phase_of_a_run():
    n = 1200
    t = np.arange(n)
    contact = ((t % 80) < 30) & (t > 300) & (t < 900)
    acc = np.where((t > 250) & (t < 950), 8 * np.sin(t * 2 * np.pi / 80), 0.0)
    phase = P.foot_phase(acc, contact, np.sin(t / 5.0), np.cos(t / 7.0), np.abs(np.sin(t / 9.0)) * 9)
    assert set(phase) == {0, 1, 2, 3} and not phase[:200].any() and not phase[1050:].any()
    for a in np.flatnonzero((phase[:-1] != 3) & (phase[1:] == 3)):
        assert phase[a] == P.IMPACT
    ends = np.flatnonzero((phase[:-1] == 3) & (phase[1:] != 3))
    assert (phase[ends + 1] == P.AIR).all()


def runs(x):
    out, i = [], 0
    while i < len(x):
        j = i
        while j < len(x) and x[j] == x[i]:
            j += 1
        if x[i]:
            out.append((i, j))
        i = j
    return out


def plain_double(left, right, pad):
    out = [False] * len(left)
    for a, b in runs(left):
        for c, d in runs(right):
            if a - pad < d + pad and c - pad < b + pad:
                out[c:d] = [True] * (d - c)
            if a < d + pad and c - pad < b:
                out[a:b] = [True] * (b - a)
    return out


def test_double_marks_equal_loops(spark):
    rng = random.Random(5)
    data = {s: [(rng.random() < 0.2, rng.random() < 0.2) for _ in range(60)] for s in range(12)}
    df = spark.createDataFrame([(s, i, *v) for s, x in data.items() for i, v in enumerate(x)], "session_id long, seq long, l boolean, r boolean")
    for pad in (1, 3):
        out = P._near_other(df, F.col("l"), F.col("r"), pad, "session_id", "seq").orderBy("session_id", "seq").collect()
        expected = [v for s in sorted(data) for v in plain_double([x[0] for x in data[s]], [x[1] for x in data[s]], pad)]
        assert [r["_double"] for r in out] == expected


def test_stance_codes(spark):
    left = [1] * 80 + [0] * 10 + [1] * 4 + [2] * 3 + [3] * 2 + [0] * 3 + [1] * 8 + [1] * 3 + [1] * 80
    right = [1] * 80 + [0] * 10 + [1] * 4 + [1] * 3 + [1] * 2 + [1] * 3 + [1] * 8 + [2] * 3 + [1] * 80
    df = spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate(zip(left, right))], "session_id long, seq long, lf int, rf int")
    got = [r["stance"] for r in P.stance(df, "lf", "rf", F.lit(False), F.lit(0.0), 100).orderBy("seq").collect()]
    assert got[:110] == [1] * 80 + [3] * 10 + [1] * 4 + [2] * 8 + [1] * 8 and got[110:] == [2] * 3 + [1] * 80
    long = spark.createDataFrame([(1, i, 0, 0) for i in range(120)], "session_id long, seq long, lf int, rf int")
    assert {r["stance"] for r in P.stance(long, "lf", "rf", F.lit(False), F.lit(0.0), 100).collect()} == {5}
    assert {r["stance"] for r in P.stance(long, "lf", "rf", F.lit(True), F.lit(9.0), 100).collect()} == {0}


def test_clean_force(spark):
    force = [0.0] * 20 + [900.0] * 30 + [0.0] * 3 + [900.0] * 30 + [0.0] * 20 + [150.0] * 12 + [0.0] * 20 + [900.0] * 8 + [0.0] * 10
    df = spark.createDataFrame([(1, i, f, f, None if i == 25 else f) for i, f in enumerate(force)], "session_id long, seq long, t double, l double, r double")
    out = P.clean_force(df, "t", "l", "r", F.lit(700.0)).orderBy("seq").collect()
    assert [i for i, r in enumerate(out) if r["lf_ind"]] == list(range(20, 83)) == [i for i, r in enumerate(out) if r["rf_ind"]]
    assert out[25]["r"] == 900_000.0 and out[108]["t"] == 0.0


def test_standing(spark):
    pitch = [0.1] * 80 + [2.0] * 100 + [0.1] * 60 + [2.0] * 300 + [0.0] * 30
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(pitch)], "session_id long, seq long, p double")
    got = [r["standing"] for r in P.standing(df, "p").orderBy("seq").collect()]
    assert got == [1] * 240 + [0] * 330


def test_filters_run_where_a_foot_moves(spark, monkeypatch):
    """Short and still sessions never reach the hip's filters, and results are as with all of them."""
    calls, plain = [], P.filter_data
    monkeypatch.setattr(P, "filter_data", lambda *a, **k: calls.append(1) or plain(*a, **k))
    t = np.arange(400)
    hip = (np.sin(t / 5.0), np.cos(t / 7.0), np.abs(np.sin(t / 9.0)))
    assert not P.foot_phase(9 * np.sin(t[:99] / 4.0), t[:99] % 2, *(h[:99] for h in hip)).any() and not calls
    assert not P.foot_phase(np.sin(t / 4.0) / 9, t % 2, *hip).any() and len(calls) == 1
    assert P.foot_phase(9 * np.sin(t / 4.0), t // 30 % 2, *hip).any() and len(calls) == 5
