"""A built session from raw records to nested blocks."""

import numpy as np
from pyspark.sql import functions as F

from stridelake.operators.calibrate import conjugate, multiply
from stridelake.plans import session as S
from stridelake.sources import records
from tests.test_records import record


def build():
    """Still, a march of 45 degree steps, a pause, then 30 s of running."""
    n = 250 + 500 + 150 + 3000
    t = np.arange(n)
    march, run = (t >= 250) & (t < 750), t >= 900
    feet = []
    for shift in (0, 60):
        wave = np.sin((t - 250 + shift) * 2 * np.pi / 120)
        pitch = np.where(march, np.radians(45) * np.clip(wave, 0, None), np.where(run, np.radians(30) * np.sin((t + shift) * 2 * np.pi / 75), 0.0))
        bump = np.where(march, 1500.0 * (np.clip(wave, 0, None) > 0.98), np.where(run, 1800 * np.clip(np.sin((t + shift) * 2 * np.pi / 75), 0, None), 0))
        q = np.stack((np.cos(pitch / 2), 0 * pitch, np.sin(pitch / 2), 0 * pitch), 1)
        down = np.zeros((n, 4))
        down[:, 3] = 1000 + bump
        feet.append((q, multiply(multiply(conjugate(q), down), q)[:, 1:]))
    hip = np.where(run, 900 * np.sin(t * 2 * np.pi / 37.5), 0.0)
    hips = (np.tile([1.0, 0, 0, 0], (n, 1)), np.stack((hip / 3, 0 * hip, 1000 + hip), 1))
    moving = (march | run).astype(int)
    fields = lambda v, scale: np.round(v * scale).astype(int).tolist()
    out = []
    for i in range(n):
        sensors = [(8 * moving[i], fields(acc[i] / 8, 1), fields(q[i][1:] * 32767 / 8, 1)) for q, acc in (feet[0], hips, feet[1])]
        out.append(record(1000 + 10 * i, sensors))
    return b"".join(out)


def test_session_end_to_end(spark):
    data = build()
    parts = spark.createDataFrame([("run", "p1", data[:60_000]), ("run", "p2", data[60_000:]), ("short", "p1", data[:4_000])], "session_id string, part string, content binary")
    motion, failures = S.calibrate(records.decode(parts))
    motion = motion.cache()
    assert [tuple(r) for r in failures.collect()] == [("short", "transformandplacement", "MARCH_DETECTION")]
    assert motion.count() == 3900
    still = motion.where("seq BETWEEN 20 AND 200").agg(F.max(F.abs("acc_hip_z"))).first()
    assert still[0] < 0.1
    samples = S.staged(S.contacts(motion)).cache()
    assert {r[0] for r in samples.select("stance").distinct().collect()} <= {0, 1, 2, 3, 4, 5}
    steps, blocks = S.steps(samples), S.blocks(samples)
    found = blocks.collect()
    assert len(found) == 1 and 20_000 < found[0]["end_ms"] - found[0]["start_ms"] < 32_000
    rows = steps.collect()
    assert rows and all(100 <= r["duration_ms"] <= 1500 for r in rows)
    assert any(r["ankle_pitch_range"] is not None for r in rows) and any(r["knee_valgus"] is not None for r in rows)
    assert S.nested(blocks, steps).count() == 1
