"""Signal kernels that need a whole session in order: numpy inside grouped Arrow functions.

A session is one group, sorted by ``seq``; nulls are filled with zero where the operator
says so.  Spark partitions and shuffles the sessions; one session (72 MB an hour of 25
doubles at 100 Hz) is a task's unit, since recursive filters and sequential peak rules
cannot be cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stridelake.operators.ranges import KEY, SEQ


def butterworth(order: int, low: float | None, high: float | None, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (b, a) of a digital low-pass, high-pass or band-pass filter.

    Analogue prototype poles are pre-warped and moved to the band, then mapped by the
    bilinear transform.
    """
    poles = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    warp = lambda f: 4 * np.tan(np.pi * f / rate)
    zeros: np.ndarray = np.zeros(0, complex)
    if low is None:
        poles, gain = poles * warp(high), warp(high) ** order
    elif high is None:
        gain = float(np.real(1 / np.prod(-poles)))
        poles, zeros = warp(low) / poles, np.zeros(order, complex)
    else:
        a, b = warp(low), warp(high)
        half, centre = poles * (b - a) / 2, a * b
        root = np.sqrt(half**2 - centre)
        poles, zeros, gain = np.concatenate((half + root, half - root)), np.zeros(order, complex), (b - a) ** order
    scale = gain * np.real(np.prod(4 - zeros) / np.prod(4 - poles))
    zeros = np.concatenate(((4 + zeros) / (4 - zeros), -np.ones(len(poles) - len(zeros))))
    return scale * np.real(np.poly(zeros)), np.real(np.poly((4 + poles) / (4 - poles)))


def _recursive(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Direct form II transposed over the rows of ``x`` (samples x signals), in place."""
    z = state.copy()
    tail_b, tail_a = b[1:, None], a[1:, None]
    for i, now in enumerate(x):
        y = b[0] * now + z[0]
        z[:-1] = z[1:]
        z[-1] = 0
        z += tail_b * now - tail_a * y
        x[i] = y
    return x


def forward_backward(b: np.ndarray, a: np.ndarray, x: np.ndarray, pad: int | None = None) -> np.ndarray:
    """Zero-phase filtering with odd extension and steady initial states."""
    x = np.asarray(x, float)
    flat = x.ndim == 1
    x = x[:, None] if flat else x
    n = max(len(a), len(b))
    b, a = np.pad(b, (0, n - len(b))), np.pad(a, (0, n - len(a)))
    pad = 3 * n if pad is None else pad
    if len(x) <= pad:
        raise ValueError(f"a signal needs more than {pad} samples")
    companion = np.eye(n - 1) - np.vstack((-a[1:], np.eye(n - 2, n - 1))).T
    steady = np.linalg.solve(companion, b[1:] - a[1:] * b[0])[:, None]
    wide = np.concatenate((2 * x[:1] - x[pad:0:-1], x, 2 * x[-1:] - x[-2 : -pad - 2 : -1]))
    once = _recursive(b, a, wide, steady * wide[0])[::-1]
    both = _recursive(b, a, once, steady * once[0])[::-1]
    out = both[pad : len(both) - pad] if pad else both
    return out[:, 0] if flat else out


def filter_data(x: np.ndarray, kind: str = "band", low: float = 0.1, high: float = 40.0, rate: float = 97.5, order: int = 4) -> np.ndarray:
    """Butterworth filter forwards and backwards; ``kind`` is low or band."""
    b, a = butterworth(order, None if kind == "low" else low, high, rate)
    return forward_backward(b, a, x)


def peaks_above(x: np.ndarray, height: float | None = None, distance: int = 1) -> np.ndarray:
    """Local maxima (middle of a plateau), the highest first where they are too close."""
    x = np.asarray(x, float)
    if len(x) < 3:
        return np.zeros(0, int)
    change = np.flatnonzero(np.diff(x)) + 1
    begin, end = np.concatenate(([0], change)), np.concatenate((change, [len(x)]))
    level = x[begin]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1 if len(level) > 2 else np.zeros(0, int)
    found = (begin[top] + end[top] - 1) // 2
    if height is not None:
        found = found[x[found] >= height]
    return _keep_apart(found, x[found], distance, np.argsort(x[found], kind="stable")[::-1], strict=True)


def _keep_apart(found: np.ndarray, heights: np.ndarray, distance: int, order: np.ndarray, strict: bool) -> np.ndarray:
    """Greedy choice in ``order``: a kept peak removes those nearer than the distance."""
    keep = np.ones(len(found), bool)
    if distance > 1 or not strict:
        for k in order:
            if keep[k]:
                gap = np.abs(found - found[k])
                keep &= ~((gap < distance) if strict else (gap <= distance)) | (np.arange(len(found)) == k)
    return found[keep]


def detect_peaks(x: np.ndarray, least: float | None = None, distance: int = 1, threshold: float = 0.0, edge: str | None = "rising", valley: bool = False) -> np.ndarray:
    """Peaks by amplitude; ``edge`` says which end of a plateau counts.

    Peaks beside missing values, and the first and last sample, are none.  A higher peak
    removes all within the distance, its own place plus and minus.
    """
    x = np.asarray(x, float) * (-1 if valley else 1)
    if len(x) < 3:
        return np.zeros(0, int)
    rise, fall = np.diff(x)[:-1], -np.diff(x)[1:]
    strict = (rise > 0) & (fall > 0)
    mark = strict.copy()
    if edge in ("rising", "both"):
        mark |= (rise > 0) & (fall >= 0)
    if edge in ("falling", "both"):
        mark |= (rise >= 0) & (fall > 0)
    missing = np.isnan(x)
    mark &= ~(missing[1:-1] | missing[:-2] | missing[2:])
    found = np.flatnonzero(mark) + 1
    if least is not None:
        found = found[x[found] >= least]
    if threshold > 0:
        found = found[np.minimum(x[found] - x[found - 1], x[found] - x[found + 1]) >= threshold]
    if distance > 1:
        found = _keep_apart(found, x[found], distance, np.argsort(x[found], kind="stable")[::-1], strict=False)
    return found


def spectrum(x: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """One-sided magnitude spectrum under a four-term Blackman-Harris window: (frequency, magnitude)."""
    n = len(x)
    terms = (0.35875, 0.48829, 0.14128, 0.01168)  # fixed values: the window's coefficients
    phase = 2 * np.pi * np.arange(n) / max(n - 1, 1)
    window = sum((-1) ** k * c * np.cos(k * phase) for k, c in enumerate(terms))
    size = 1 << max(n - 1, 1).bit_length()
    magnitude = np.abs(np.fft.rfft(np.asarray(x, float) * window, size)) / max(n, 1)
    magnitude[1:-1] *= 2
    return np.fft.rfftfreq(size, 1 / rate), magnitude


#: Upper cadence of walking, jogging and running, and the codes of the zones.
ZONES, ZONE_CODES = (130.0, 165.0, 195.0), (10, 20, 30, 40)


def cadence_zones(active: np.ndarray, pitch: np.ndarray, rate: float = 97.5, hold: int = 1000) -> np.ndarray:
    """Zone of each sample: cadence from pitch peaks in each active run.

    A run needs more than ten peaks.  The zone of the first ten peaks is that of their mean
    cadence; later it changes only after ``hold`` samples in the old one.
    """
    out = np.zeros(len(active), int)
    degrees = np.degrees(filter_data(np.nan_to_num(pitch), "band", high=35.0, rate=rate))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (active == 1).astype(int), [0]))))
    for begin, end in zip(edge[::2], edge[1::2]):
        end = min(end, len(active) - 1)
        found = peaks_above(degrees[begin:end], 20.0, 30)
        if len(found) <= 10:
            continue
        step = np.diff(found, prepend=2 * found[0] - found[1]).astype(float)
        smooth = _mean3(step)
        smooth[smooth > 400] = np.nan
        cadence = _mean3(12_000 / _edges(smooth))
        cadence = _edges(cadence)
        place = found + begin
        first = np.nanmean(cadence[:10]) if not np.isnan(cadence[:10]).all() else 100.0
        zone, since = _zone(int(first)), begin
        for k in range(10, len(cadence)):
            if k == len(cadence) - 1:
                break
            new = zone if np.isnan(cadence[k]) else _zone(cadence[k])
            if new != zone and place[k] - since >= hold:
                out[since : place[k]] = new
                zone, since = new, place[k]
            elif new == zone and not np.isnan(cadence[k]):
                out[since : place[k]] = zone
                since = place[k]
        out[since:end] = zone
    return out


def _zone(cadence: float) -> int:
    return ZONE_CODES[int(np.searchsorted(ZONES, cadence, "left"))]


def _mean3(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([np.nan], (x[:-2] + x[1:-1] + x[2:]) / 3, [np.nan]))


def _edges(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x[0], x[-1] = x[1], x[-2]
    return x


def dickey_fuller(y: np.ndarray) -> tuple[float, float]:
    """Augmented Dickey-Fuller statistic with constant, and its 5 % critical value.

    Lags up to ceil(12 (n/100)^(1/4)) are compared by AIC on a common sample.  Series that
    are too short or constant give (-1, 0).
    """
    y = np.asarray(y, float)
    n = len(y)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2) if n else -1
    if most < 0 or n < 8 or np.ptp(y) == 0:
        return -1.0, 0.0
    d = np.diff(y)

    def fit(lag: int, skip: int) -> tuple[float, float, int]:
        rows = np.arange(skip, len(d))
        design = np.column_stack([y[rows], *(d[rows - k] for k in range(1, lag + 1)), np.ones(len(rows))])
        beta, *_ = np.linalg.lstsq(design, d[rows], rcond=None)
        rest = d[rows] - design @ beta
        free = len(rows) - design.shape[1]
        cov = np.linalg.pinv(design.T @ design) * (rest @ rest / max(free, 1))
        aic = len(rows) * np.log(max(rest @ rest, 1e-300) / len(rows)) + 2 * design.shape[1]
        return beta[0] / np.sqrt(max(cov[0, 0], 1e-300)), aic, len(rows)

    best = min(range(most + 1), key=lambda k: fit(k, most)[1])
    statistic, _, used = fit(best, best)
    return float(statistic), float(-2.86154 - 2.8903 / used - 4.234 / used**2 - 40.04 / used**3)  # fixed values: response surface


def per_session(df: DataFrame, function, schema: str, key: str = KEY, seq: str = SEQ, types: dict[str, pa.DataType] | None = None) -> DataFrame:
    """Runs ``function(columns: dict of arrays) -> dict of columns`` on each session in order.

    ``types`` has the Arrow types of nested columns.  A plain column that is empty or all
    null (a session without a single step) takes the type that the schema names.
    """
    plain = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
    kinds = {c.split()[0]: plain.get(c.split()[1]) for c in schema.split(", ")} | (types or {})

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(seq)
        out = function({c: table.column(c).to_numpy() for c in table.column_names})
        # Lists without a value would become columns of nulls.
        return pa.table({n: pa.array(out[n], k) if k is not None and isinstance(out[n], list) else out[n] for n, k in kinds.items()})

    return df.groupBy(key).applyInArrow(run, schema)
