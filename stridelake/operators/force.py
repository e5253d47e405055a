"""Features of ground reaction force, and prediction by a model that the caller brings.

No trained weights are public, so :data:`LINEAR` is a documented stand-in: forces as linear
functions of features.  Any object of the same form (a weight by feature for each output)
fits, and so does a function of a pandas frame for :func:`predict_with`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.operators.phases import clean_force, low_passed
from stridelake.operators.ranges import KEY, SEQ, by_seq
from stridelake.operators.signal import filter_data, per_session
from stridelake.sources.models import apply_model

SIDES = ("lf", "hip", "rf")
_SHARP = (("lf", "z"), ("hip", "x"), ("hip", "y"), ("hip", "z"), ("rf", "z"))
#: The features, in order: accelerations, angles, their changes, magnitudes and their changes.
FEATURES = [
    *(f"acc_{s}_{a}" for s, a in _SHARP), *(f"euler_{s}_{a}" for s in SIDES for a in "xy"), *(f"euler_{s}_{a}_d" for s in SIDES for a in "xyz"),
    *(f"acc_{s}_{a}_d" for s, a in _SHARP), *(f"acc_{s}" for s in SIDES), *(f"acc_{s}_d" for s in SIDES),
]
#: A change of angle over this (radians) is a wrap, not a turn.
WRAP = 3.0
LINEAR = {"grf_lf": {"acc_lf": 0.02, "acc_hip_z": 0.01}, "grf_rf": {"acc_rf": 0.02, "acc_hip_z": 0.01}}


def features(df: DataFrame, mass: Column, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """``key, seq``, the features and ``mass`` of samples with acc and euler of lf, hip and rf; rows with a missing one go."""
    w = by_seq(key, seq)
    out = df.withColumns({f"acc_{s}": F.sqrt(sum(F.col(f"acc_{s}_{a}") * F.col(f"acc_{s}_{a}") for a in "xyz")) for s in SIDES})
    changes = {}
    for c in FEATURES:
        if c.endswith("_d"):
            d = F.col(c[:-2]) - F.lag(c[:-2]).over(w)
            changes[c] = F.when(F.abs(d) > WRAP, 0.0).otherwise(d) if c.startswith("euler") else d
    return out.withColumns(changes).select(key, seq, *FEATURES, mass.alias("mass")).dropna(subset=FEATURES)


def smoothed(found: DataFrame, high: float = 6.0, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Features through a zero-phase low-pass (sessions of 15 rows or fewer as they are)."""

    def run(c: dict) -> dict:
        x = np.stack([c[f] for f in FEATURES], 1)
        x = filter_data(x, "low", high=high) if len(x) > 15 else x
        return {key: c[key], seq: c[seq], **{f: x[:, i] for i, f in enumerate(FEATURES)}, "mass": c["mass"]}

    kinds = dict(found.dtypes)
    return per_session(found, run, f"{key} {kinds[key]}, {seq} {kinds[seq]}, " + ", ".join(f"{f} double" for f in FEATURES) + ", mass double", key, seq)


def predict(found: DataFrame, weights: dict[str, dict[str, float]]) -> DataFrame:
    """Adds a force (at least 0) for each output of a linear model; plain column arithmetic."""
    return found.withColumns({out: F.greatest(sum(F.col(f) * F.lit(v) for f, v in own.items()), F.lit(0.0)) for out, own in weights.items()})


def forces(df: DataFrame, mass_kg: float, scaler: str, model: str, outputs: tuple[str, str, str] = ("grf_lf", "grf_rf", "grf"), key: str = KEY, seq: str = SEQ) -> DataFrame:
    """Samples with clean forces and contacts (F10, F11, F12), by the scaler and model at two paths.

    Features go through the 6 Hz low-pass, the model's forces through one of 18 Hz; then
    thresholds, gaps and contacts are cleaned by weight.  Samples without features take the
    force before them.  The model may take ``mass`` as its last feature.
    """
    weight = mass_kg * 9.807 / 1000
    found = smoothed(features(df, F.lit(weight), key, seq), key=key, seq=seq)
    predicted = apply_model(found, scaler, model, [*FEATURES, "mass"], list(outputs)).select(key, seq, *outputs)
    filtered = low_passed(predicted, list(outputs), key=key, seq=seq)
    whole = df.select(key, seq).join(filtered, [key, seq], "left")
    left, right, total = outputs
    return clean_force(whole, total, left, right, F.lit(weight), key, seq)


def predict_with(found: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], outputs: list[str]) -> DataFrame:
    """Adds the outputs of a model that takes batches of features; the model travels with the tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.concat([batch, model(batch)[outputs]], axis=1)

    schema = ", ".join(f"{n} {t}" for n, t in found.dtypes) + "".join(f", {o} double" for o in outputs)
    return found.mapInPandas(run, schema)
