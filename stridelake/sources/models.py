"""Scalers and force models as files, fitted by sums in tasks and applied once loaded by each worker.

A scaler and a model are two JSON files with their format, version and features in order; a
model names the digest of the scaler that it was fitted behind.  Loading checks all of
them, and so does every batch that a model is applied to, so a model never meets features
in another order.  Files travel with the job (``addFile``), from any store that Spark reads.

No trained weights are public: :func:`fit` makes the documented stand-in, a linear model of
scaled features.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALER, MODEL, VERSION = "scaler", "linear-force", 1


class ModelError(ValueError):
    """A file that is no scaler or model of this version, or features that are not the model's."""


@dataclass(frozen=True)
class Scaler:
    features: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.mean)) / np.array(self.scale)


@dataclass(frozen=True)
class Model:
    features: tuple[str, ...]
    outputs: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    bias: tuple[float, ...]
    #: Digest of the scaler's file.
    scaler: str

    def apply(self, x: np.ndarray) -> np.ndarray:
        return x @ np.array(self.weights).reshape(len(self.features), len(self.outputs)) + np.array(self.bias)


def dumps(thing: Scaler | Model) -> str:
    return json.dumps({"format": SCALER if isinstance(thing, Scaler) else MODEL, "version": VERSION} | asdict(thing), sort_keys=True)


def digest(thing: Scaler | Model) -> str:
    return hashlib.sha256(dumps(thing).encode()).hexdigest()


def loads(text: str, kind: type[Scaler] | type[Model]) -> Scaler | Model:
    """The scaler or model of a file's text."""
    try:
        said = json.loads(text)
        form, version = said.pop("format"), said.pop("version")
        if form != (SCALER if kind is Scaler else MODEL) or version != VERSION:
            raise ModelError(f"expected {kind.__name__} of version {VERSION}, found {form} of version {version}")
        tuples = {k: tuple(map(tuple, v)) if k == "weights" else tuple(v) if isinstance(v, list) else v for k, v in said.items()}
        out = kind(**tuples)
    except (KeyError, TypeError, AttributeError, json.JSONDecodeError) as e:
        raise ModelError(f"no {kind.__name__} of version {VERSION}: {e}") from e
    sizes = [len(v) for k, v in tuples.items() if k in ("mean", "scale", "weights")]
    if any(n != len(out.features) for n in sizes) or kind is Model and any(len(row) != len(out.outputs) for row in out.weights):
        raise ModelError("numbers do not fit the features")
    return out


def save(spark: SparkSession, thing: Scaler | Model, path: str) -> None:
    """One file at ``path``, in any store that Hadoop opens; an existing one is replaced."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(dumps(thing).encode()))
    finally:
        out.close()


@lru_cache(maxsize=8)
def loaded(scaler: str, model: str) -> tuple[Scaler, Model]:
    """The two files that travelled with the job; once a worker."""
    with open(SparkFiles.get(scaler), encoding="utf-8") as f:
        own = loads(f.read(), Scaler)
    with open(SparkFiles.get(model), encoding="utf-8") as f:
        fitted = loads(f.read(), Model)
    if fitted.scaler != digest(own) or fitted.features != own.features:
        raise ModelError("the model was fitted behind another scaler")
    return own, fitted


def apply_model(found: DataFrame, scaler: str, model: str, features: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """``found`` with the outputs of the model at path ``model`` behind the scaler at path ``scaler``.

    ``features`` is the order in which they are handed in, which must be the model's.
    """
    context = found.sparkSession.sparkContext
    for path in (scaler, model):
        context.addFile(path)
    names = [os.path.basename(p) for p in (scaler, model)]
    wanted, given = tuple(outputs), tuple(features)

    @F.pandas_udf(", ".join(f"`{o}` double" for o in wanted))
    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, fitted = loaded(*names)
        if fitted.features != given or fitted.outputs != wanted:
            raise ModelError(f"the model takes {fitted.features} and gives {fitted.outputs}")
        for batch in batches:
            yield pd.DataFrame(fitted.apply(own.apply(batch.to_numpy(float))), columns=list(wanted))

    columns = [c for c in found.columns if c not in wanted]
    out = found.withColumn("_model", predicted(F.struct(*(F.col(f).cast("double").alias(f) for f in given))))
    return out.select(*columns, *(F.col("_model")[o].alias(o) for o in wanted))


def fit_scaler(found: DataFrame, features: Sequence[str]) -> Scaler:
    """Mean and population deviation of each feature, by one aggregate; a feature without spread keeps its scale."""
    row = found.agg(*(F.avg(f).alias(f"m{i}") for i, f in enumerate(features)), *(F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features))).first()
    n = len(features)
    return Scaler(tuple(features), tuple(float(row[i] or 0.0) for i in range(n)), tuple(float(row[n + i] or 0.0) or 1.0 for i in range(n)))


def fit(found: DataFrame, features: Sequence[str], targets: dict[str, str], ridge: float = 1e-9) -> tuple[Scaler, Model]:
    """A scaler and the linear model of least squares; ``targets`` maps outputs to columns.

    Each task adds up products of its rows; one matrix of (features + 1) squared plus the
    targets, whatever the input, reaches the driver.  Rows with a missing value are left out.
    """
    found = found.select(*(F.col(f).cast("double") for f in features), *(F.col(t).cast("double").alias(f"_target_{o}") for o, t in targets.items())).dropna()
    scaler = fit_scaler(found, features)
    n, wide = len(features), len(features) + 1 + len(targets)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for batch in batches:
            raw = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            x = np.concatenate((scaler.apply(raw[:, :n]), np.ones((len(raw), 1)), raw[:, n:]), 1)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(wide), wide)), pa.array(np.tile(np.arange(wide), wide)), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((wide, wide))
    for r in found.mapInArrow(products, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"]
    count = max(total[n, n], 1.0)
    solved = np.linalg.lstsq(total[: n + 1, : n + 1] / count + ridge * np.diag([*[1.0] * n, 0.0]), total[: n + 1, n + 1 :] / count, rcond=None)[0]
    return scaler, Model(tuple(features), tuple(targets), tuple(map(tuple, solved[:n].tolist())), tuple(solved[n].tolist()), digest(scaler))
