"""Inline vectors and properties of ranges, gap filling and merging."""

import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators import joins, ranges


def frame(spark, values, key=1):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)], "session_id long, seq long, x double")


def got(df, value, closed_end="drop_last"):
    return sorted([r["start"], r["end"]] for r in ranges.ranges(df, F.col("x") == value, closed_end).collect())


def plain_runs(x, value, closed_end):
    """Runs of a value by a loop over the samples."""
    found, begin = [], None
    for i, v in enumerate([*x, None]):
        if begin is None and v == value and i < len(x):
            begin = i
        elif begin is not None and (i == len(x) or v != value):
            end = i - 1 if i == len(x) and closed_end == "drop_last" else i
            if end > begin:
                found.append([begin, end])
            begin = None
    return found


@pytest.mark.parametrize("closed_end", ["drop_last", "exact"])
def test_runs_equal_a_loop(spark, closed_end):
    rng = random.Random(17)
    for n in (1, 2, 9, 40):
        x = [rng.choice([4.0, 7.0, 7.0, 9.0, None]) for _ in range(n - 1)] + [7.0]
        for value in (4.0, 7.0, 9.0):
            assert got(frame(spark, x), value, closed_end) == plain_runs(x, value, closed_end)


def plain_fill(x, value, k, new):
    x, n, i = list(x), len(x), 0
    out = list(x)
    while i < n:
        j = i
        while j < n and x[j] == x[i]:
            j += 1
        end = j - 1 if j == n else j
        if x[i] == value and end - i < k:
            for t in range(i, end):
                out[t] = new
        i = j
    return out


def test_fill_short_runs_equals_loop(spark):
    rng = random.Random(2)
    data = {s: [rng.randint(0, 1) for _ in range(rng.randint(1, 60))] for s in range(30)}
    df = spark.createDataFrame([(s, i, v) for s, x in data.items() for i, v in enumerate(x)], "session_id long, seq long, x int")
    out = ranges.fill_short_runs(ranges.fill_short_runs(df, "x", 0, 3, 1), "x", 1, 5, 0).orderBy("session_id", "seq").collect()
    expected = [v for s in sorted(data) for v in plain_fill(plain_fill(data[s], 0, 3, 1), 1, 5, 0)]
    assert [r["x"] for r in out] == expected


def test_gap_of_exactly_the_bound_merges(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 20, 30), (1, 41, 50)], "session_id long, start long, end long")
    assert sorted((r["start"], r["end"]) for r in ranges.merge_ranges(df, 10).collect()) == [(0, 30), (41, 50)]
    assert sorted((r["start"], r["end"]) for r in ranges.merge_ranges(df, 11, strict=True).collect()) == [(0, 30), (41, 50)]
    assert len(ranges.merge_ranges(df, 10, strict=True).collect()) == 3


def test_band_join_equals_all_pairs(spark):
    rng = random.Random(8)
    left = [(rng.randint(0, 3), rng.randint(-50, 50)) for _ in range(60)]
    right = [(rng.randint(0, 3), rng.randint(-50, 50)) for _ in range(60)]
    l = spark.createDataFrame(left, "k int, a long")  # noqa: E741
    r = spark.createDataFrame(right, "k int, b long")
    out = sorted((x["k"], x["a"], x["b"]) for x in joins.band_join(l, r, ["k"], "a", "b", 7).collect())
    assert out == sorted((k, a, b) for k, a in left for q, b in right if k == q and abs(a - b) <= 7)


def test_empty_frame(spark):
    df = frame(spark, [])
    assert got(df, 1) == [] and ranges.fill_short_runs(df, "x", 0, 3, 1).count() == 0


def test_tile_activity_in_any_order(spark):
    """A sample that lies 20 from the mean but for the last bit is judged by the sum in order, however rows arrive."""
    values = [3.87, 15.48, 7.34, 68.79]  # in order the mean is 23.87; other orders give 23.870000000000005
    found = set()
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2), (2, 3, 1, 0)):
        rows = [(1, k, values[k]) for k in order] + [(1, k, 0.0) for k in range(4, 8)]
        tiles = ranges.tile_activity(spark.createDataFrame(rows, "session_id long, seq long, x double").coalesce(1), ["x"], 4, 20, 0.3)
        found |= {tuple(r) for r in tiles.collect()}
    assert found == {(1, 0, 0)}
