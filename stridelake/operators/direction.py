"""Changes of direction from the heading at each stride of the hip."""

from __future__ import annotations

import numpy as np

from stridelake.operators.signal import filter_data, peaks_above


def changes_of_direction(acc_z: np.ndarray, heading: np.ndarray, rate: float = 97.5, cutoff: float = 4.0, height: float = 1.5, distance: int = 20, back: int = 6, angle: float = 40.0, bridge: int = 200) -> np.ndarray:
    """1 around strides whose folded, smoothed heading (degrees) differs by over ``angle`` from that ``back`` strides before.

    Strides are peaks of the filtered vertical acceleration.  A change marks ``back`` strides
    on either side; marks closer than ``bridge`` samples are one.  Sessions with no more than
    2 back + 1 strides have no change.
    """
    out = np.zeros(len(acc_z), np.int64)
    if len(acc_z) <= 15:
        return out
    strides = peaks_above(filter_data(acc_z, "low", high=cutoff, rate=rate), height, distance)
    if len(strides) <= 2 * back + 1:
        return out
    folded = np.abs(heading[strides])
    smooth = np.convolve(folded, np.full(3, 1 / 3), "valid")
    smooth = np.concatenate((smooth[:1], smooth, [np.nan]))  # the first takes its neighbour's value, the last has none
    turned = np.flatnonzero(np.abs(smooth[back:-1] - smooth[: -back - 1]) > angle) + back
    for i in turned:
        out[strides[i - back] : strides[min(i + back, len(strides) - 1)]] = 1
    edges = np.flatnonzero(np.diff(np.concatenate(([1], out, [1]))))
    for a, b in zip(edges[::2], edges[1::2]):
        b = min(b, len(out) - 1)
        if b - a < bridge:
            out[a:b] = 1
    return out
