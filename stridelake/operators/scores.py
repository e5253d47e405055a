"""Scores of measures: consistency within a distribution, symmetry between two, and the spline that maps them.

All rows count; nothing is sampled.  A group's distribution reaches a kernel only as sums or
as a histogram of bounded size, so a hot group costs no task more memory than a small one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions.lineage import cut
from stridelake.operators.ranking import quantiles
from stridelake.operators.windows import cumulative_share

#: Least number of values, least deviation for symmetry, percentiles of full and no score, points of a mapping, factor of the bandwidth.
LEAST_VALUES, LEAST_SPREAD, FULL, NONE, MAP_POINTS, BANDWIDTH = 5, 1e-4, 0.05, 0.95, 1000, 1.06
#: Steps of a histogram in a bandwidth, and its largest size.
FINE, MOST_CELLS = 8, 65_536
#: Rounds of the mixture at most, and the growth of its mean log-likelihood that ends them.
ROUNDS, TOLERANCE = 100, 1e-3
#: Different values of a group that one task takes, and about as many in a bucket of groups.
MOST_VALUES = 131_072
#: Cells of histograms in a bucket of groups, about; trials of a spline's weight on a step of its grid, and numbers of a band of the splines that are solved at once.
CELLS_TOGETHER, TRIALS, SIDE_BY_SIDE = 32_768, 24, 1 << 16
#: Parts of a step of that grid, and of the whole in four steps; logarithm of the first weight tried, and the trials by secants before halves take turns.
STEPS, WEIGHTS, FIRST_GUESS, GUESSES = TRIALS - 1, (TRIALS - 1) ** 4, 0.0, 8


def clipped(score: Column) -> Column:
    """The score within 0 and 100; null stays."""
    return F.when(score.isNotNull(), F.greatest(F.least(score, F.lit(100.0)), F.lit(0.0)))


def _by(df: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows joined to one row a group, null-safe; adaptive execution splits hot groups."""
    named = few.select(*(F.col(k).alias(f"_by_{k}") for k in keys), *(c for c in few.columns if c not in keys))
    return df.join(named, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in keys)), "left").drop(*(f"_by_{k}" for k in keys))


def consistency(df: DataFrame, keys: Sequence[str], value: str, name: str = "consistency") -> DataFrame:
    """``df`` with a score of 100 near the mean of its group and 0 far from it.

    The squared deviation is scaled so that its 5th percentile scores 100 and its 95th
    scores 0.  Groups of under five values, or without spread, have no score.
    """
    known = F.col(value).isNotNull() & ~F.isnan(value)
    moments = cut(df.where(known).groupBy(*keys).agg(F.avg(value).alias("_mean"), F.var_pop(value).alias("_var"), F.count(F.lit(1)).alias("_n")))
    away = F.when(known, (F.col(value) - F.col("_mean")) ** 2 / (F.col("_n") * F.nullif("_var", F.lit(0.0))))
    ratio = _by(df, moments, keys).withColumn("_ratio", away)
    ends = cut(quantiles(ratio, keys, "_ratio", {"_best": FULL, "_worst": NONE}))
    score = (1 - (F.col("_ratio") - F.col("_best")) / F.nullif(F.col("_worst") - F.col("_best"), F.lit(0.0))) * 100
    return _by(ratio, ends, keys).select(*df.columns, F.when(F.col("_n") >= LEAST_VALUES, clipped(score)).alias(name))


def mixture(df: DataFrame, keys: Sequence[str], value: str, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Two normal components of each group by expectation maximisation: ``share, low, low_var, high, high_var, loglik, n``.

    ``share`` is that of the lower component.  Equal values are counted once in advance.  It
    starts from the values below and above the mean, and ends when no group's mean
    log-likelihood grows by more than the tolerance.  Groups of under five values, or without
    spread, are left out.

    Groups of up to :data:`MOST_VALUES` different values move to a bucket of many groups, which
    a kernel runs through all rounds at once: first to learn in which rounds one of them
    still grows, then as far as the whole table goes.  A round of larger groups is one sum over
    their values (weights, first and second moments of both components).
    """
    values = df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys, F.col(value).cast("double").alias("_x")).agg(F.count(F.lit(1)).cast("double").alias("_w"))
    values = cut(values)
    whole = values.groupBy(*keys).agg(F.sum("_w").alias("_n"), (F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("_mean"), F.count(F.lit(1)).alias("_many"))
    spread = cut(_by(values, whole, keys).where(F.col("_n") >= LEAST_VALUES).withColumn("_d", F.col("_x") - F.col("_mean")))
    small, large = spread.where(F.col("_many") <= MOST_VALUES), spread.where(F.col("_many") > MOST_VALUES)
    buckets = small.count() // MOST_VALUES + 1
    small = small.select(*keys, "_d", "_w", "_mean", F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"))
    types = dict(df.dtypes)
    key_schema = "".join(f"`{k}` {types[k]}, " for k in keys)

    def growing(table: pa.Table) -> pa.Table:
        group, _, d, w = _grouped(table, keys)
        grows = _rounds(group, d, w, rounds, tolerance)[1]
        return pa.table({"_round": pa.array(np.flatnonzero(grows), pa.int64())})

    # At most one row a round.
    still = {r[0] for r in small.groupBy("_bucket").applyInArrow(growing, "_round long").distinct().collect()} if rounds else set()
    done = next((r + 1 for r in range(rounds) if r not in still), rounds)
    state = None
    if not large.isEmpty():
        state, done = _large_rounds(large, keys, rounds, tolerance, still)

    def run(table: pa.Table) -> pa.Table:
        group, first, d, w = _grouped(table, keys)
        fit = _rounds(group, d, w, done, tolerance)[0]
        kept = pa.array(first[fit.pop("at")])
        rows = table.take(kept)
        return pa.table({k: rows.column(k) for k in keys} | {"mean": rows.column("_mean")} | {n: pa.array(v, pa.float64()) for n, v in fit.items()})

    found = small.groupBy("_bucket").applyInArrow(run, key_schema + "mean double, " + ", ".join(f"{n} double" for n in _FITTED))
    state = found if state is None else found.unionByName(state.select(found.columns))
    swap = F.col("low") > F.col("high")
    pick = lambda a, b: F.when(swap, b).otherwise(a)
    m, low, high = F.col("mean"), F.col("low"), F.col("high")
    return state.select(*keys, pick(F.col("share"), 1 - F.col("share")).alias("share"), (m + pick(low, high)).alias("low"), pick(F.col("low_var"), F.col("high_var")).alias("low_var"), (m + pick(high, low)).alias("high"), pick(F.col("high_var"), F.col("low_var")).alias("high_var"), "loglik", F.col("n").cast("long").alias("n"))


#: Columns of a fitted group beside its keys and mean; low and high are distances from the mean.
_FITTED = ("n", "share", "low", "low_var", "high", "high_var", "loglik")


def _grouped(table: pa.Table, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_numbered`, with the rows' deviations and weights."""
    return *_numbered(table, keys), table.column("_d").to_numpy(), table.column("_w").to_numpy()


def _numbered(table: pa.Table, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group (nulls are a key like others) and a row of each group."""
    group = np.zeros(len(table), np.int64)
    for k in keys:
        code = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        group = np.unique(group * (len(code.dictionary) + 1) + code.indices.to_numpy(), return_inverse=True)[1]
    return group, np.unique(group, return_index=True)[1]


def _rounds(group: np.ndarray, d: np.ndarray, w: np.ndarray, rounds: int, tolerance: float) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The parameters of all groups after so many rounds (``at``: numbers of the groups with spread), and whether one grew in each."""
    order = np.argsort(group, kind="stable")
    group, d, w = group[order], d[order], w[order]
    size = np.bincount(group)
    floor = np.bincount(group, w * d * d) / np.bincount(group, w)
    at = np.flatnonzero(floor > 0)
    keep = np.repeat(floor > 0, size)
    d, w, floor, size = d[keep], w[keep], floor[at], size[at]
    grows = np.zeros(rounds, bool)
    if not len(at):
        return {"at": at, **{n: np.zeros(0) for n in _FITTED}}, grows
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    sums = lambda v: np.add.reduceat(v, starts)
    n = sums(w)

    def maximised(low_w: np.ndarray) -> tuple[np.ndarray, ...]:
        out = []
        for part in (low_w, w - low_w):
            total, one = sums(part), part * d
            mean, square = sums(one) / np.maximum(total, 1e-300), sums(one * d) / np.maximum(total, 1e-300)
            out += [mean, np.maximum(square - mean * mean, floor * 1e-6), total]
        return (np.clip(out[2] / n, 1e-12, 1 - 1e-12), out[0], out[1], out[3], out[4])

    state, loglik = maximised(np.where(d < 0, w, 0.0)), np.full(len(at), -np.inf)
    for r in range(rounds):
        share, low, low_var, high, high_var = state
        a, b = (np.repeat(np.log(p / np.sqrt(2 * np.pi * v)), size) - (d - np.repeat(m, size)) ** 2 / np.repeat(2 * v, size) for p, m, v in ((share, low, low_var), (1 - share, high, high_var)))
        top = np.maximum(a, b)
        total = top + np.log1p(np.exp(np.minimum(a, b) - top))
        before, loglik = loglik, sums(w * total) / n
        grows[r] = bool((loglik - before > tolerance).any())
        state = maximised(w * np.exp(a - total))
    return {"at": at, "n": n, **dict(zip(_FITTED[1:], (*state, loglik)))}, grows


def _large_rounds(spread: DataFrame, keys: Sequence[str], rounds: int, tolerance: float, still: set[int]) -> tuple[DataFrame, int]:
    """The parameters of groups of any size and the rounds they took: as many as one of them, or of ``still``, grows in."""
    below = F.when(F.col("_d") < 0, F.col("_w")).otherwise(0.0)
    sums = spread.groupBy(*keys).agg(
        F.first("_n").alias("n"), F.first("_mean").alias("mean"), (F.sum(F.col("_w") * F.col("_d") ** 2) / F.first("_n")).alias("floor"),
        F.sum(below).alias("w"), F.sum(below * F.col("_d")).alias("a1"), F.sum(below * F.col("_d") ** 2).alias("a2"),
        F.sum(F.col("_w") - below).alias("v"), F.sum((F.col("_w") - below) * F.col("_d")).alias("b1"), F.sum((F.col("_w") - below) * F.col("_d") ** 2).alias("b2"), F.lit(float("-inf")).alias("loglik"), F.lit(None).cast("double").alias("before"),
    ).where("floor > 0")
    state, done = cut(_maximised(sums, keys)), rounds
    values = spread.select(*keys, "_d", "_w")
    for r in range(rounds):
        met = _by(values, state, keys).where("n IS NOT NULL")
        low, high = (_density(F.col("_d"), F.col(m), F.col(s), w) for m, s, w in (("low", "low_var", F.col("share")), ("high", "high_var", 1 - F.col("share"))))
        top = F.greatest(low, high)
        total = top + F.log(F.exp(low - top) + F.exp(high - top))
        met = met.withColumn("_r", F.col("_w") * F.exp(low - total)).withColumn("_q", F.col("_w") - F.col("_r"))
        d = F.col("_d")
        sums = met.groupBy(*keys).agg(
            F.first("n").alias("n"), F.first("mean").alias("mean"), F.first("floor").alias("floor"),
            F.sum("_r").alias("w"), F.sum(F.col("_r") * d).alias("a1"), F.sum(F.col("_r") * d * d).alias("a2"),
            F.sum("_q").alias("v"), F.sum(F.col("_q") * d).alias("b1"), F.sum(F.col("_q") * d * d).alias("b2"), (F.sum(F.col("_w") * total) / F.first("n")).alias("loglik"), F.first("loglik").alias("before"),
        )
        state = cut(_maximised(sums, keys))
        if r not in still and state.where(F.col("loglik") - F.col("before") > tolerance).isEmpty():
            done = r + 1
            break
    return state, done


def _density(d: Column, mean: Column, var: Column, weight: Column) -> Column:
    """Logarithm of a weighted normal density."""
    return F.log(weight) - (d - mean) ** 2 / (2 * var) - F.log(2 * np.pi * var) / 2


def _maximised(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parameters (means as distances from the group's mean) from the sums; no variance falls under a millionth of the group's."""
    part = lambda a, w: F.col(a) / F.greatest(F.col(w), F.lit(1e-300))
    least = F.col("floor") * 1e-6
    share = F.greatest(F.least(F.col("w") / F.col("n"), F.lit(1 - 1e-12)), F.lit(1e-12))
    return sums.select(
        *keys, "n", "mean", "floor", "loglik", "before", share.alias("share"), part("a1", "w").alias("low"), F.greatest(part("a2", "w") - part("a1", "w") ** 2, least).alias("low_var"),
        part("b1", "v").alias("high"), F.greatest(part("b2", "v") - part("b1", "v") ** 2, least).alias("high_var"),
    )


def consistency_of_two(df: DataFrame, keys: Sequence[str], value: str, name: str = "consistency") -> DataFrame:
    """As :func:`consistency`, within the likelier of two components.

    Where no value is likelier in one of them, the group is scored whole.
    """
    parts = ("share", "low", "low_var", "high", "high_var")
    met = _by(df, cut(mixture(df, keys, value).select(*keys, F.struct(*parts).alias("_mix"))), keys)
    x = F.col(value).cast("double")
    share, low, low_var, high, high_var = (F.col("_mix")[p] for p in parts)
    side = _density(x, high, high_var, 1 - share) > _density(x, low, low_var, share)
    marked = met.select(*df.columns, F.coalesce(side, F.lit(False)).cast("int").alias("_component"))
    return consistency(marked, [*keys, "_component"], value, name).select(*df.columns, name)


def weighted(df: DataFrame, symmetry: str, control: str, force: str, elapsed: str, scores: Sequence[str] = (), scale: float = 1.0, key: str = "session_id", seq: str = "seq") -> DataFrame:
    """Score combination of three sensors: the destructive share of force by symmetry and control, and scores weighted by force.

    Adds ``destr_multiplier, dest_grf, const_grf, session_duration`` and
    ``session_grf_elapsed`` (running shares of time and force).
    """
    grf = F.abs(force) / scale
    off = lambda c: (1 - F.col(c) / 100) ** 2
    out = df.withColumn("destr_multiplier", (off(symmetry) + off(control)) / 2).withColumn("_grf", grf)
    out = out.withColumns({"dest_grf": F.col("_grf") * F.col("destr_multiplier"), "session_duration": cumulative_share(elapsed, key, seq), "session_grf_elapsed": cumulative_share("_grf", key, seq)})
    out = out.withColumn("const_grf", F.col("_grf") - F.col("dest_grf"))
    return out.withColumns({c: F.col(c) * F.col("_grf") for c in dict.fromkeys((symmetry, *scores))}).drop("_grf")


def weighted_of_one(df: DataFrame, control: str, elapsed: str, key: str = "session_id", seq: str = "seq") -> DataFrame:
    """Score combination of one sensor: control alone makes the destructive share; there is no force."""
    return df.withColumn("destr_multiplier", (1 - F.col(control) / 100) ** 2).withColumn("session_duration", cumulative_share(elapsed, key, seq))


def smoothing_spline(x: np.ndarray, y: np.ndarray, weight: np.ndarray, stress: float) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`smoothing_splines`, for one curve."""
    return smoothing_splines([(x, y, weight, stress)])[0]


def smoothing_splines(curves: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each curve (x, y, weight, stress) the knots' values and second derivatives of the cubic spline with the least curvature whose weighted squared residuals sum to ``stress`` at most.

    ``x`` ascends strictly.  The weight of the curvature is searched on a grid of its
    logarithm that narrows four times, where secants lead (halves, if those take long); each
    trial is a symmetric system of five bands (the widths' three and the smoothing's five), so
    the work is linear in the points.  Curves of about as many points are solved side by side,
    :data:`SIDE_BY_SIDE` numbers at once.
    """
    out = [(y.astype(float), np.zeros(len(y))) for _, y, _, _ in curves]
    order = sorted((i for i, c in enumerate(curves) if len(c[0]) >= 3), key=lambda i: -len(curves[i][0]))
    while order:
        together = max(1, SIDE_BY_SIDE // len(curves[order[0]][0]))
        for i, found in zip(order, _splines_of_a_size([curves[i] for i in order[:together]])):
            out[i] = found
        order = order[together:]
    return out


def _splines_of_a_size(curves: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Splines of curves (the longest first), one a column; shorter ones are filled up by points that hold nothing."""
    sizes, stress = np.array([len(c[0]) for c in curves]), np.array([c[3] for c in curves])
    n, k = int(sizes[0]), len(curves)
    x, y, weight = np.repeat(np.arange(n, dtype=float)[:, None], k, 1), np.zeros((n, k)), np.ones((n, k))
    for j, (own, *rest, _) in enumerate(curves):
        x[: len(own), j], x[len(own) :, j] = own, own[-1] + np.arange(1, n - len(own) + 1)
        y[: len(own), j], weight[: len(own), j] = rest
    h = np.diff(x, axis=0)
    right = np.diff(np.diff(y, axis=0) / h, axis=0)
    # Columns of Q hold 1/h[i], -1/h[i] - 1/h[i+1], 1/h[i+1]; Q' diag(1/w) Q has five bands.
    a, b, c = 1 / h[:-1], -1 / h[:-1] - 1 / h[1:], 1 / h[1:]
    v = 1 / weight
    bands = [a * a * v[:-2] + b * b * v[1:-1] + c * c * v[2:], b[:-1] * a[1:] * v[1:-2] + c[:-1] * b[1:] * v[2:-1], c[:-2] * a[2:] * v[2:-2]]
    widths = [(h[:-1] + h[1:]) / 3, h[1:-1] / 6]
    scale = np.array([widths[0][: m - 2, j].mean() / bands[0][: m - 2, j].mean() for j, m in enumerate(sizes.tolist())])
    # A system of m - 2 rows ends there: what follows is the unit matrix with nothing on the right.
    row = np.arange(n - 2)[:, None]
    right[row >= sizes - 2] = 0.0
    for parts in (bands, widths):
        for far, part in enumerate(parts):
            part[row[: len(part)] + far >= sizes - 2] = 0.0
    widths[0][row >= sizes - 2] = 1.0

    def fits(smooth: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values and second derivatives of the curves ``at``, each for its weight."""
        main, near, far = (q[:, at] * smooth for q in bands)
        main += widths[0][:, at]
        near += widths[1][:, at]
        gamma = _five_bands(main, near, far, right[:, at])
        bend = np.zeros((n, len(at)))
        bend[:-2] += a[:, at] * gamma
        bend[1:-1] += b[:, at] * gamma
        bend[2:] += c[:, at] * gamma
        return y[:, at] - smooth * v[:, at] * bend, gamma

    found, curved, at = np.zeros((n, k)), np.zeros((n, k)), np.arange(k)
    # Numbers of the last weight that is known to keep the stress and of the first that does not; the last two trials and their logarithms of residuals over stress.
    best, fails = np.full(k, -1), np.full(k, WEIGHTS)
    here, gap, before, past = np.full(k, 40.0), np.zeros(k), np.full(k, np.nan), np.full(k, np.nan)

    def tried(smooth: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which of the curves ``at`` keep their stress; those keep the trial, as later ones are smoother."""
        values, gamma = fits(scale[at] * np.exp(smooth), at)
        left = (weight[:, at] * (y[:, at] - values) ** 2).sum(0)
        kept = left <= stress[at]
        found[:, at[kept]], curved[1:-1, at[kept]] = values[:, kept], gamma[:, kept]
        before[at], past[at], here[at], gap[at] = here[at], gap[at], smooth, np.log(np.maximum(left, 1e-300)) - np.log(np.maximum(stress[at], 1e-300))
        return kept

    at, guess, trial = at[~tried(here[at], at)], np.full(k, FIRST_GUESS), 0
    while len(at):
        number = np.floor((guess[at] + 40) / 80 * WEIGHTS)
        if trial >= GUESSES and trial % 2:
            number = (best[at] + fails[at]) // 2
        number = np.clip(np.nan_to_num(number), best[at] + 1, fails[at] - 1).astype(int)
        kept = tried(_weight_of(number), at)
        best[at[kept]], fails[at[~kept]], trial = number[kept], number[~kept], trial + 1
        # By their logarithms residuals grow with the weight, at most squared: a secant of such a slope leads to the next guess.
        slope = (gap[at] - past[at]) / (here[at] - before[at]) if trial > 1 else np.full(len(at), 1.0)
        guess[at] = here[at] - gap[at] / np.clip(slope, 0.05, 2.0)
        at = at[fails[at] - best[at] > 1]
    least = np.flatnonzero((best < 0) & (fails == 0))
    if len(least):
        found[:, least], curved[1:-1, least] = fits(scale[least] * np.exp(-40.0), least)
    return [(found[:m, j].copy(), curved[:m, j].copy()) for j, m in enumerate(sizes.tolist())]


def _weight_of(number: np.ndarray) -> np.ndarray:
    """Logarithms of the weights so numbered: four times a step of the grid is divided as the whole was."""
    low, high = np.full(len(number), -40.0), np.full(len(number), 40.0)
    for inner in (WEIGHTS // STEPS**k for k in range(1, 5)):
        own, number = np.divmod(number, inner)
        step = (high - low) / STEPS
        low, high = own * step + low, np.where(own + 1 == STEPS, high, (own + 1) * step + low)
    return low


def _five_bands(main: np.ndarray, near: np.ndarray, far: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solutions of symmetric positive systems (one a column) with two bands on either side, by their LDL' factors."""
    n, k = main.shape
    d, e, f, z = (np.zeros((n + 2, k)) for _ in range(4))
    for i in range(n):
        d[i] = main[i] - e[i - 1] ** 2 * d[i - 1] - f[i - 2] ** 2 * d[i - 2]
        if i + 1 < n:
            e[i] = (near[i] - e[i - 1] * f[i - 1] * d[i - 1]) / d[i]
        if i + 2 < n:
            f[i] = far[i] / d[i]
        z[i] = right[i] - e[i - 1] * z[i - 1] - f[i - 2] * z[i - 2]
    out = np.zeros((n + 2, k))
    for i in range(n - 1, -1, -1):
        out[i] = z[i] / d[i] - e[i] * out[i + 1] - f[i] * out[i + 2]
    return out[:n]


def _spline_at(df: DataFrame, x: Column, name: str) -> DataFrame:
    """``df`` with the value of its ``_spline`` in the piece that holds x, straight on beyond the ends, in place of the spline.

    Each step is a projection of its own: as one expression it would be longer than the JVM compiles.
    """
    spline, t, s, r, step = F.col("_spline"), F.col("_t"), F.col("_s"), 1 - F.col("_s"), F.col("_step")
    y0, y1, g0, g1 = (F.col(c) for c in ("_y0", "_y1", "_g0", "_g1"))
    keep = [c for c in df.columns if c != "_spline"]
    out = df.withColumn("_from", (x - spline["first"]) / spline["step"])
    out = out.withColumn("_at", F.greatest(F.least(F.floor("_from").cast("int"), F.size(spline["y"]) - 2), F.lit(0)))
    held = [F.get(spline[c], F.col("_at") + k).alias(f"_{c}{k}") for c in ("y", "g") for k in (0, 1)]
    out = out.select(*keep, (F.col("_from") - F.col("_at")).alias("_t"), spline["step"].alias("_step"), *held)
    out = out.withColumn("_s", F.greatest(F.least(t, F.lit(1.0)), F.lit(0.0)))
    curve = r * y0 + s * y1 - step * step / 6 * (s * r * ((1 + r) * g0 + (1 + s) * g1))
    slope = F.when(t < 0, (y1 - y0) - step * step / 6 * (2 * g0 + g1)).when(t > 1, (y1 - y0) + step * step / 6 * (g0 + 2 * g1)).otherwise(0.0)
    return out.select(*keep, (curve + (t - s) * slope).alias(name))


def densities(weights: np.ndarray, step: float, n: float, width: float) -> np.ndarray:
    """Gaussian kernel density at the nodes of a histogram of linear weights."""
    reach = min(int(np.ceil(6 * width / step)), len(weights))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) * step / width) ** 2) / (width * np.sqrt(2 * np.pi) * n)
    size = 1 << (len(weights) + len(kernel) - 2).bit_length()
    full = np.fft.irfft(np.fft.rfft(weights, size) * np.fft.rfft(kernel, size), size)
    return np.maximum(full[reach : reach + len(weights)], 0.0)


Sides = dict[str, dict[str, float]]
Cells = dict[str, tuple[np.ndarray, np.ndarray]]
Maps = dict[str, tuple[float, float, np.ndarray, np.ndarray]]


def symmetry_maps(cells: Cells, first: float, step: float, sides: Sides) -> Maps:
    """As :func:`maps_of_groups`, for one group."""
    return maps_of_groups([(cells, first, step, sides)])[0]


def maps_of_groups(groups: Sequence[tuple[Cells, float, float, Sides]]) -> list[Maps]:
    """For each group (cells, first node, distance of nodes, sides) and side: first point, distance of points, values and second derivatives of the map from a value to its score.

    ``cells`` has each side's cell numbers and weights; ``sides`` its ``n``, ``std``, ``min`` and ``max``.
    """
    curves, spots = [], []
    for cells, first, step, sides in groups:
        length = 1 + max(int(at.max()) for at, _ in cells.values())
        nodes, dense = first + step * np.arange(length), {}
        for side, (at, w) in cells.items():
            weights = np.zeros(length)
            np.add.at(weights, at.astype(int), w)
            own = sides[side]
            # Silverman's rule on as many values as the smaller side has.
            dense[side] = densities(weights, step, own["n"], BANDWIDTH * own["std"] * min(s["n"] for s in sides.values()) ** -0.2)
        for own in sides.values():
            points = np.linspace(own["min"], own["max"], int(min(own["n"], MAP_POINTS)))
            left, right = (np.interp(points, nodes, dense[s]) for s in ("LF", "RF"))
            score = (1 - np.abs(left - right) / max(left.max(), right.max())) * 100
            curves.append((points, score, np.ones(len(points)), float(len(points))))
            spots.append((float(points[0]), float(points[1] - points[0])))
    found = iter([(*spot, *spline) for spot, spline in zip(spots, smoothing_splines(curves))])
    return [{side: next(found) for side in sides} for *_, sides in groups]


def symmetry(df: DataFrame, keys: Sequence[str], side: str, value: str, name: str = "symmetry") -> DataFrame:
    """``df`` with the agreement (0 to 100) of the two sides' densities at each value.

    ``side`` is LF or RF.  The densities come from a histogram with linear weights, eight cells
    to the narrower bandwidth.  Groups with under five values on a side, or without spread on
    one, have no score; neither have rows without a side or a value.
    """
    known = F.col(value).isNotNull() & ~F.isnan(value) & F.col(side).isin("LF", "RF")
    of = lambda f, s: f(F.when(F.col(side) == s, F.col(value)))
    clean = df.where(known)
    stats = clean.groupBy(*keys).agg(*(of(f, s).alias(f"{n}_{s}") for s in ("LF", "RF") for n, f in (("n", F.count), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))))
    stats = stats.where(f"n_LF >= {LEAST_VALUES} AND n_RF >= {LEAST_VALUES} AND std_LF >= {LEAST_SPREAD} AND std_RF >= {LEAST_SPREAD}")
    low, high = F.least("min_LF", "min_RF"), F.greatest("max_LF", "max_RF")
    narrow = BANDWIDTH * F.least("std_LF", "std_RF") * F.least("n_LF", "n_RF") ** -0.2
    stats = cut(stats.withColumn("_first", low).withColumn("_step", (high - low) / F.least(F.ceil((high - low) / (narrow / FINE)), F.lit(MOST_CELLS - 1))))
    place = (F.col(value) - F.col("_first")) / F.col("_step")
    inside = _by(clean.select(*keys, side, value), stats, keys).where("_step IS NOT NULL").withColumn("_cell", F.floor(place).cast("int")).withColumn("_part", place - F.floor(place))
    cells = inside.groupBy(*keys, F.col(side).alias("_side"), "_cell").agg(F.count(F.lit(1)).cast("double").alias("_count"), F.sum("_part").alias("_upper"))
    # Groups move to buckets of many; at most two times MOST_CELLS rows a group, however large it is.
    span = (high - low) / F.col("_step") + 2
    many = stats.agg(F.sum(sum(F.least(F.col(f"n_{s}"), span) for s in ("LF", "RF")))).first()[0] or 0
    joined = _by(cells, stats, keys).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(int(many) // CELLS_TOGETHER + 1)))
    numbers = [f"{n}_{s}" for s in ("LF", "RF") for n in ("n", "std", "min", "max")]
    types = dict(df.dtypes)
    schema = "".join(f"`{k}` {types[k]}, " for k in keys) + "_side string, _spline struct<first: double, step: double, y: array<double>, g: array<double>>"

    def run(table: pa.Table) -> pa.Table:
        group, heads = _numbered(table, keys)
        right = table.column("_side").to_numpy() == "RF"
        order = np.lexsort((right, group))
        # Rows of a group's left side, then of its right side; both have rows.
        edges = np.searchsorted(2 * group[order] + right[order], np.arange(2 * len(heads) + 1))
        cell, count, upper = (table.column(c).to_numpy()[order] for c in ("_cell", "_count", "_upper"))
        at, weight = (cell, cell + 1), (count - upper, upper)
        few = table.take(pa.array(heads))
        first, step = (few.column(c).to_numpy() for c in ("_first", "_step"))
        known = {s: {n: few.column(f"{n}_{s}").to_numpy().astype(float) for n in ("n", "std", "min", "max")} for s in ("LF", "RF")}
        groups = []
        for i in range(len(heads)):
            parts = {s: slice(edges[2 * i + j], edges[2 * i + j + 1]) for j, s in enumerate(("LF", "RF"))}
            weights = {s: tuple(np.concatenate([x[p] for x in pair]) for pair in (at, weight)) for s, p in parts.items()}
            groups.append((weights, float(first[i]), float(step[i]), {s: {n: float(x[i]) for n, x in known[s].items()} for s in known}))
        found = [m for maps in maps_of_groups(groups) for m in maps.values()]
        lists = lambda c: pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(m[c]) for m in found]))).astype(np.int32), np.concatenate([m[c] for m in found]))
        spline = pa.StructArray.from_arrays([pa.array([m[0] for m in found]), pa.array([m[1] for m in found]), lists(2), lists(3)], ["first", "step", "y", "g"])
        rows = few.take(pa.array(np.repeat(np.arange(len(heads)), 2)))
        return pa.table({k: rows.column(k) for k in keys} | {"_side": pa.array(["LF", "RF"] * len(heads)), "_spline": spline})

    maps = cut(joined.select(*keys, "_bucket", "_side", "_cell", "_count", "_upper", "_first", "_step", *numbers).groupBy("_bucket").applyInArrow(run, schema))
    met = _by(df.withColumn("_side", F.col(side)), maps, [*keys, "_side"])
    scored = _spline_at(met.select(*df.columns, "_spline"), F.col(value).cast("double"), "_score")
    return scored.select(*df.columns, F.when(known, clipped(F.col("_score"))).alias(name))
