"""Quantiles, consistency, mixtures, symmetry and splines against numpy on whole arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.operators import scores as C
from stridelake.operators.ranking import placed, quantiles


def frame(spark, rows, schema="g string, x double, k int"):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    out = [("hot", float(v)) for v in rng.gamma(2, 10, 600).round(1)] + [("b", float(v)) for v in rng.normal(0, 1, 40)]
    out += [("same", 3.0)] * 6 + [("few", 1.0), ("few", 2.0), ("few", 4.0)] + [(None, float(v)) for v in range(9)] + [("b", None), ("b", float("nan")), ("none", None)]
    return out


def groups(rows):
    out = {}
    for g, x in rows:
        if x is not None and x == x:
            out.setdefault(g, []).append(x)
    return {g: np.array(v) for g, v in out.items()}


def test_places_and_quantiles(spark, rows):
    got = {r["g"]: r for r in quantiles(frame(spark, rows), ["g"], "x", {"a": 0.05, "m": 0.5, "z": 0.95, "top": 1.0}).collect()}
    want = groups(rows)
    assert got.keys() == want.keys()
    for g, v in want.items():
        assert np.allclose([got[g][c] for c in ("a", "m", "z", "top")], np.quantile(v, [0.05, 0.5, 0.95, 1]))
    spot = placed(frame(spark, rows).where("x IS NOT NULL AND NOT isnan(x)"), ["g"], "x").collect()
    for g, v in want.items():
        own = sorted((r["place"], r["x"]) for r in spot if r["g"] == g)
        assert [p for p, _ in own] == list(range(len(v))) and [x for _, x in own] == sorted(v) and {r["size"] for r in spot if r["g"] == g} == {len(v)}


def consistency(v):
    if len(v) < 5 or v.var() == 0:
        return np.full(len(v), np.nan)
    ratio = (v - v.mean()) ** 2 / (len(v) * v.var())
    low, high = np.percentile(ratio, [5, 95])
    return np.clip((1 - (ratio - low) / (high - low)) * 100, 0, 100)


def test_consistency(spark, rows):
    out = C.consistency(frame(spark, rows), ["g"], "x").collect()
    assert len(out) == len(rows)
    by_k = {r["k"]: r["consistency"] for r in out}
    for g, v in groups(rows).items():
        mine = [by_k[k] for k, (h, x) in enumerate(rows) if h == g and x is not None and x == x]
        assert np.allclose(np.array(mine, float), consistency(v), equal_nan=True)
    assert all(by_k[k] is None for k, (_, x) in enumerate(rows) if x is None or x != x)


def test_mixture_finds_planted_components(spark):
    rng = np.random.default_rng(1)
    a = np.concatenate((rng.normal(10, 1, 1400), rng.normal(20, 2, 600)))
    b = np.concatenate((rng.normal(-5, 0.5, 300), rng.normal(5, 0.5, 700)))
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("same", 1.0)] * 8 + [("few", 1.0), ("few", 2.0), ("b", None)]
    got = {r["g"]: r for r in C.mixture(frame(spark, rows), ["g"], "x", tolerance=1e-9).collect()}
    assert got.keys() == {"a", "b"}
    for g, share, low, high, s, t in (("a", 0.7, 10, 20, 1, 2), ("b", 0.3, -5, 5, 0.5, 0.5)):
        r = got[g]
        assert abs(r["share"] - share) < 0.02 and abs(r["low"] - low) < 0.15 and abs(r["high"] - high) < 0.25
        assert abs(r["low_var"] ** 0.5 - s) < 0.1 and abs(r["high_var"] ** 0.5 - t) < 0.2
    # One round is one step of the plain algorithm.
    v, m = a, a.mean()
    w = np.where(v < m, 1.0, 0.0)
    p = [w.mean(), (w * v).sum() / w.sum(), 0, (v[w == 0]).mean(), 0]
    p[2], p[4] = v[w == 1].var(), v[w == 0].var()
    pdf = lambda mean, var: np.exp(-((v - mean) ** 2) / 2 / var) / np.sqrt(2 * np.pi * var)
    lo, hi = p[0] * pdf(p[1], p[2]), (1 - p[0]) * pdf(p[3], p[4])
    r = lo / (lo + hi)
    low = (r * v).sum() / r.sum()
    once = C.mixture(frame(spark, rows).where("g = 'a'"), ["g"], "x", rounds=1).first()
    assert np.allclose([once["share"], once["low"], once["low_var"], once["loglik"]], [r.mean(), low, (r * (v - low) ** 2).sum() / r.sum(), np.log(lo + hi).mean()])


def test_consistency_of_two(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate((rng.normal(0, 1, 300), rng.normal(50, 3, 200)))
    rows = [("a", float(x)) for x in v] + [("one", float(x)) for x in rng.normal(0, 1e-3, 3)] + [("a", None)]
    df = frame(spark, rows).withColumn("share", F.lit(1))
    out = C.consistency_of_two(df, ["g"], "x").orderBy("k").collect()
    assert np.allclose([r["consistency"] for r in out[:500]], np.concatenate((consistency(v[:300]), consistency(v[300:]))))
    assert all(r["consistency"] is None and r["share"] == 1 for r in out[500:])


def dense(x, y, w, smooth):
    """The penalised fit by whole matrices."""
    n, h = len(x), np.diff(x)
    q, r = np.zeros((n, n - 2)), np.zeros((n - 2, n - 2))
    for j in range(n - 2):
        q[j, j], q[j + 1, j], q[j + 2, j] = 1 / h[j], -1 / h[j] - 1 / h[j + 1], 1 / h[j + 1]
        r[j, j] = (h[j] + h[j + 1]) / 3
        if j + 1 < n - 2:
            r[j, j + 1] = r[j + 1, j] = h[j + 1] / 6
    k = q @ np.linalg.solve(r, q.T)
    return np.linalg.solve(np.diag(w) + smooth * k, w * y)


def test_spline_equals_a_dense_solve():
    rng = np.random.default_rng(3)
    x = np.sort(rng.uniform(0, 10, 60))
    y, w = np.sin(x) + rng.normal(0, 0.3, 60), rng.uniform(0.5, 2, 60)
    values, gamma = C.smoothing_spline(x, y, w, 5.0)
    stress = (w * (y - values) ** 2).sum()
    assert 4.9 < stress <= 5.0
    low, high = 1e-8, 1e8
    for _ in range(200):
        middle = np.sqrt(low * high)
        low, high = (middle, high) if (w * (y - dense(x, y, w, middle)) ** 2).sum() <= stress else (low, middle)
    assert np.allclose(values, dense(x, y, w, low), atol=1e-5)
    # The second derivatives are those of the natural spline through the values.
    h = np.diff(x)
    assert np.allclose((h[:-1] * gamma[:-2] + 2 * (h[:-1] + h[1:]) * gamma[1:-1] + h[1:] * gamma[2:]) / 6, np.diff(np.diff(values) / h), atol=1e-8) and gamma[0] == gamma[-1] == 0
    # A loose bound gives the line of least squares, a bound of nothing the points.
    line = np.polyfit(x, y, 1, w=np.sqrt(w))
    assert np.allclose(C.smoothing_spline(x, y, w, 1e9)[0], np.polyval(line, x), atol=1e-4)
    assert np.allclose(C.smoothing_spline(x, y, w, 0.0)[0], y, atol=1e-6)


def whole_density(points, values, width):
    return np.exp(-0.5 * ((points[:, None] - values[None]) / width) ** 2).mean(1) / (width * np.sqrt(2 * np.pi))


def at_spline(v, x, y, g):
    """The cubic through two knots with the second derivatives there, from its Taylor polynomial at the left one."""
    k = np.clip(np.searchsorted(x, v, "right") - 1, 0, len(x) - 2)
    h, t = x[k + 1] - x[k], v - x[k]
    slope = (y[k + 1] - y[k]) / h - h * (2 * g[k] + g[k + 1]) / 6
    return y[k] + t * (slope + t * (g[k] / 2 + t * (g[k + 1] - g[k]) / (6 * h)))


def test_symmetry_equals_whole_densities(spark):
    rng = np.random.default_rng(4)
    left, right = rng.normal(10, 2, 900), rng.normal(11, 3, 700)
    sides = [("a", "LF", float(v)) for v in left] + [("a", "RF", float(v)) for v in right] + [("a", None, 1.0), ("a", "LF", None), ("few", "LF", 1.0)] + [("flat", s, 2.0) for s in ("LF", "RF") for _ in range(6)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(sides)], "g string, side string, x double, k int")
    out = C.symmetry(df, ["g"], "side", "x").orderBy("k").collect()
    assert len(out) == len(sides) and all(r["symmetry"] is None for r in out[1600:])
    for values, rows in ((left, out[:900]), (right, out[900:1600])):
        points = np.linspace(values.min(), values.max(), min(len(values), 1000))
        a, b = (whole_density(points, v, 1.06 * v.std() * 700**-0.2) for v in (left, right))
        score = (1 - np.abs(a - b) / max(a.max(), b.max())) * 100
        got = np.array([r["symmetry"] for r in rows])
        knots, bend = C.smoothing_spline(points, score, np.ones(len(points)), float(len(points)))
        assert np.sqrt(np.mean((knots - score) ** 2)) <= 1
        assert np.abs(got - np.clip(at_spline(values, points, knots, bend), 0, 100)).max() < 0.1
        maps = C.symmetry_maps({"LF": (np.arange(2), np.ones(2)), "RF": (np.arange(2), np.ones(2))}, 0.0, 1.0, {s: {"n": 5.0, "std": 1.0, "min": 0.0, "max": 1.0} for s in ("LF", "RF")})
        assert np.allclose(maps["LF"][2], 100)


def test_linear_weights_give_the_density():
    rng = np.random.default_rng(5)
    v = rng.normal(0, 1, 500)
    width, step = 0.3, 0.3 / C.FINE
    first = v.min()
    at = np.floor((v - first) / step).astype(int)
    part = (v - first) / step - at
    weights = np.zeros(at.max() + 2)
    np.add.at(weights, at, 1 - part)
    np.add.at(weights, at + 1, part)
    nodes = first + step * np.arange(len(weights))
    assert np.abs(C.densities(weights, step, 500, width) - whole_density(nodes, v, width)).max() < 2e-3


def test_mixture_rounds_in_buckets(spark, monkeypatch):
    """Groups in buckets take as many rounds as groups of any size, and write nothing in a round."""
    rng = np.random.default_rng(7)
    rows = [(g, float(v)) for g in "abcde" for v in np.concatenate((rng.normal(0, 1, 60), rng.normal(ord(g) - 95, 2, 40))).round(2)] + [("even", 3.0)] * 9 + [(None, float(k)) for k in range(12)]
    df, cuts, cut = frame(spark, rows), [], C.cut
    monkeypatch.setattr(C, "cut", lambda d: cuts.append(1) or cut(d))
    small = {r["g"]: r for r in C.mixture(df, ["g"], "x").collect()}
    assert len(cuts) <= 3
    for most in (0, 90):  # all groups, and those of over 90 values, by sums
        monkeypatch.setattr(C, "MOST_VALUES", most or 1)
        large = {r["g"]: r for r in C.mixture(df, ["g"], "x").collect()}
        assert small.keys() == large.keys() == {*"abcde", None}
        for g, r in small.items():
            assert np.allclose([*r][1:], [*large[g]][1:], rtol=1e-7)


def test_splines_of_many_groups_are_solved_together(spark, monkeypatch):
    """Groups of a bucket take a few systems in all, not some for each, with the results of each alone."""
    rng = np.random.default_rng(8)
    curves = []
    for n in (3, 1, 60, 4, 2, 35, 60, 200, 5):
        x = np.sort(rng.uniform(0, 10, n))
        curves.append((x, np.sin(x) + rng.normal(0, 0.3, n), rng.uniform(0.5, 2, n), 0.05 * n))
    for (x, y, w, stress), (values, gamma) in zip(curves, C.smoothing_splines(curves)):
        alone = C.smoothing_spline(x, y, w, stress)
        assert np.array_equal(values, alone[0]) and np.array_equal(gamma, alone[1]) and (w * (y - values) ** 2).sum() <= stress * (1 + 1e-9)
    solved, bands = [], C._five_bands
    monkeypatch.setattr(C, "_five_bands", lambda *a: solved.append(1) or bands(*a))
    cells = {s: (np.arange(40), rng.uniform(0, 3, 40)) for s in ("LF", "RF")}
    C.maps_of_groups([(cells, 0.0, 1.0, {s: {"n": 30.0 + i, "std": 9.0, "min": 0.0, "max": 39.0} for s in ("LF", "RF")}) for i in range(30)])
    assert len(solved) <= 24
    # Keys that are null, buckets of one and of many groups: the scores of each group alone.
    rows = [(g, k, s, float(v)) for g, k in (("a", 1), ("a", None), (None, 1), ("b", 2)) for s in ("LF", "RF") for v in rng.normal(0, 1 + ord(s[0]) % 3, 25 + (k or 7))]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "g string, k int, side string, x double, at int")
    one = {r["at"]: r["symmetry"] for r in C.symmetry(df, ["g", "k"], "side", "x").collect()}
    assert len(one) == len(rows) and None not in one.values()
    monkeypatch.setattr(C, "CELLS_TOGETHER", 1)
    split = {r["at"]: r["symmetry"] for r in C.symmetry(df, ["g", "k"], "side", "x").collect()}
    alone = {r["at"]: r["symmetry"] for r in C.symmetry(df.where("g IS NULL"), ["g", "k"], "side", "x").collect()}
    assert all(abs(one[i] - split[i]) < 1e-9 for i in one) and all(abs(one[i] - v) < 1e-9 for i, v in alone.items())


def test_spline_weights_are_searched_by_halves(monkeypatch):
    """The last weight of the whole grid that keeps the stress, from about a fifth of its systems; a straight line takes one."""
    rng = np.random.default_rng(9)
    curves = []
    for n in (3, 4, 30, 120, 300):
        x = np.linspace(0, n / 7, n)
        curves += [(x, 50 + 50 * np.sin(x) + rng.normal(0, 2, n), np.ones(n), stress) for stress in (float(n), 0.1 * n, 0.0)]
    solved, bands = [], C._five_bands
    monkeypatch.setattr(C, "_five_bands", lambda *a: solved.append(a[0].shape[1]) or bands(*a))
    found = C.smoothing_splines(curves)
    assert sum(solved) <= 24 * len(curves)
    for (x, y, w, stress), (values, _) in zip(curves, found):
        h = np.diff(x)
        q = np.zeros((len(x), len(x) - 2))
        for i in range(len(x) - 2):
            q[i : i + 3, i] = 1 / h[i], -1 / h[i] - 1 / h[i + 1], 1 / h[i + 1]
        widths = np.diag((h[:-1] + h[1:]) / 3) + np.diag(h[1:-1] / 6, 1) + np.diag(h[1:-1] / 6, -1)
        scale = (np.trace(widths) / np.trace(q.T @ q)) if len(x) > 2 else 1
        low, high, best = -40.0, 40.0, y
        for _ in range(4):
            trials = np.linspace(low, high, C.TRIALS)
            fits = [y - s * q @ np.linalg.solve(widths + s * q.T @ q, q.T @ y) for s in scale * np.exp(trials)]
            at = max((i for i, v in enumerate(fits) if (w * (y - v) ** 2).sum() <= stress), default=0)
            best = fits[at]
            if at == C.TRIALS - 1:
                break
            low, high = trials[at], trials[at + 1]
        assert np.abs(values - best).max() < 1e-6 * (1 + np.abs(y).max())
    solved.clear()
    C.smoothing_splines([(np.arange(9.0), np.arange(9.0), np.ones(9), 9.0)])
    assert solved == [1]


def test_secants_find_the_weights_of_splines(monkeypatch):
    """Agreements of densities take some eight systems each, a curve on which secants crawl no more than halves take in turn, and numbers name the weights of the nested grid."""
    rng, curves = np.random.default_rng(10), []
    for n in range(70, 130):
        points = np.linspace(1, 50, n)
        left, right = (whole_density(points, rng.integers(1, 51, n), 6.0) for _ in range(2))
        curves.append((points, (1 - np.abs(left - right) / max(left.max(), right.max())) * 100, np.ones(n), float(n)))
    solved, bands = [], C._five_bands
    monkeypatch.setattr(C, "_five_bands", lambda *a: solved.append(a[0].shape[1]) or bands(*a))
    C.smoothing_splines(curves)
    assert sum(solved) <= 10 * len(curves)
    solved.clear()
    line = np.linspace(0, 9, 30)
    wave = np.sin(line)
    rest = float(((wave - np.polyval(np.polyfit(line, wave, 1), line)) ** 2).sum())
    C.smoothing_splines([(line, wave, np.ones(30), rest * (1 - 1e-6)), (line, wave * 1e-9, np.ones(30), 1e-30), (line, wave, np.ones(30), 0.0)])
    assert len(solved) <= 2 + C.GUESSES + 2 * 19
    low, high, number = -40.0, 40.0, 0
    for at in (11, 22, 0, 7):
        trials = np.linspace(low, high, C.TRIALS)
        low, high, number = trials[at], trials[at + 1], number * C.STEPS + at
    assert C._weight_of(np.array([number, 0])).tolist() == [low, -40.0]
