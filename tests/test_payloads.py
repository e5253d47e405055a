"""Documents of all versions against plain dictionaries."""

import json

import pytest
from pyspark.sql import functions as F

from stridelake.operators import payloads as P

BLOCKS = [(s, m, b, f"t{b}", f"u{b}", 1.0 + b if m != "hip_drop" else None, 2.0 * b, b % 2 == 1) for s in ("a", "b") for m in P.MEASURES for b in range(5)] + [("a", "apt", 9, "t9", "u9", 0.0, 0.0, True)]
STATS = [
    ("a", "apt_ankle_pitch", 1, 10, 0.5, 2.5, 0.1, 150, 1.0, 0.5), ("a", "apt_ankle_pitch", 1, 20, 0.7, -2.0, 0.1, 400, 0.2, 0.5), ("a", "apt_ankle_pitch", 1, 30, 0.9, 9.0, 0.1, 99, 9.0, 0.5),
    ("a", "apt_ankle_pitch", 2, 10, 0.3, 1.9, 0.1, 500, 2.0, 1.0), ("a", "hip_rotation_apt", 2, 10, 0.4, 3.0, 0.1, 100, 0.0, 0.0),
]
HEAD = {"user_id": "u", "event_date": "2024-01-01", "end_date": None, "seconds_duration": 60}


@pytest.fixture(scope="module")
def sessions(spark):
    blocks = spark.createDataFrame(BLOCKS, "session_id string, measure string, time_block int, start_time string, end_time string, left double, right double, significant boolean")
    stats = spark.createDataFrame(STATS, "session_id string, pattern string, side int, cadence int, elasticity double, elasticity_t double, elasticity_se double, obs long, adf double, adf_critical double")
    heads = spark.createDataFrame([(s, *HEAD.values()) for s in ("a", "b", "none")], "session_id string, user_id string, event_date string, end_date string, seconds_duration long")
    return heads.join(P.summaries(blocks), "session_id", "left").join(P.time_blocks(blocks), "session_id", "left").join(P.pattern_stats(stats), "session_id", "left")


def summary(session, measure):
    own = [b for b in BLOCKS if b[0] == session and b[1] == measure]
    if not own:
        return dict.fromkeys(P.SUMMARY)
    median = lambda v: None if not v else (sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) / 2
    events = [b for b in own if (b[5] or 0) > 0 or b[6] > 0]
    bad = sum(b[7] for b in events)
    return {"left": median([b[5] for b in own if b[5] is not None]), "right": median([b[6] for b in own]), "asymmetric_events": bad, "symmetric_events": len(events) - bad, "percent_events_asymmetric": round(bad / len(events) * 100)}


def pattern(session, name, side):
    own = [s[4:] for s in STATS if s[:3] == (session, name, side) and s[7] >= 100]
    slope = sorted((s for s in own if abs(s[1]) >= 2), key=lambda s: -s[3])
    root = sorted((s for s in own if s[4] > s[5]), key=lambda s: -s[3])
    return {"elasticity": slope[0][0] if slope else 0.0, "y_adf": root[0][4] if root else 0.0}


def expected(version, session):
    v = P.VERSIONS[version]
    out = {n: session if n == "session_id" else HEAD[n] for n in v.head}
    if not v.nested:
        s = summary(session, "apt")
        return out | {"asymmetry": {"left_apt": s["left"], "right_apt": s["right"], "asymmetric_events": s["asymmetric_events"], "symmetric_events": s["symmetric_events"]}}
    if session != "none":
        out["asymmetry"] = {m: summary(session, m) for m in v.measures}
    if v.patterns and session == "a":
        out["movement_patterns"] = {p: {n: pattern(session, p, k) for k, n in ((1, "left"), (2, "right"))} for p in v.patterns}
    return out


@pytest.mark.parametrize("version", P.VERSIONS)
def test_bodies(sessions, version):
    for r in sessions.select("session_id", P.body(version).alias("b")).collect():
        assert json.loads(r["b"]) == expected(version, r["session_id"])
    first = list(json.loads(sessions.where("session_id = 'a'").select(P.body(version)).first()[0]))
    assert first == list(expected(version, "a"))


@pytest.mark.parametrize("version", P.VERSIONS)
def test_kept_records(sessions, version):
    v = P.VERSIONS[version]
    kept = v.kept or v.measures
    for r in sessions.select("session_id", P.asymmetry_record(version).alias("b")).collect():
        got, s = json.loads(r["b"]), r["session_id"]
        blocks = sorted({b[2:5] for b in BLOCKS if b[0] == s})
        assert [(b["time_block"], b["start_time"], b["end_time"]) for b in got["time_blocks"]] == blocks
        for b in got["time_blocks"]:
            for m in kept:
                own = [x for x in BLOCKS if x[:3] == (s, m, b["time_block"])]
                want = dict(zip(("left", "right", "significant"), own[0][5:] if own else (None, None, None)))
                assert (b[m] if v.nested else {n: b[n] for n in want}) == want
        one = summary(s, "apt")
        assert (got["apt"] if v.nested else {n: got[{"left": "left_apt", "right": "right_apt"}.get(n, n)] for n in one}) == one
        assert set(kept) <= set(got) if v.nested else "apt" not in got


def test_patterns_and_versions(spark, sessions):
    got = {r["session_id"]: r for r in P.payloads(sessions.withColumn("version", F.when(F.col("session_id") == "a", "4_7").when(F.col("session_id") == "b", "9_9"))).collect()}
    kept = json.loads(got["a"]["patterns"])
    assert [list(s.values()) for s in kept["apt_ankle_pitch_stats"]] == [list(s[2:]) for s in STATS[:4]] and kept["hip_drop_apt_stats"] == []
    assert got["a"]["reserve"] is None and json.loads(got["a"]["body"]) == expected("4_7", "a")
    assert json.loads(got["b"]["body"]) == expected("4_3", "b") and got["none"]["version"] == "4_4"
    assert json.loads(got["b"]["reserve"]) == expected("4_7", "b") | {"plans_version": "4_7", "user_id": "u"}
    assert json.loads(got["none"]["body"]) == expected("4_4", "none") and json.loads(got["none"]["record"])["time_blocks"] == []
