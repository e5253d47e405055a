"""Table functions for SQL: ranges, filters and peaks of sessions.

After :func:`register`::

    SELECT * FROM session_ranges(TABLE(SELECT session_id, seq, active FROM samples) PARTITION BY session_id ORDER BY seq)

Columns are taken by place: the key, the number of the sample, and what is looked at.  Rows
come as Arrow batches in order.  Ranges hold one open range; filters and peaks, which need a
whole session, hold its one column.  The key is given back as a string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from stridelake.operators.signal import detect_peaks, filter_data

#: Samples that a zero-phase filter needs more of.
LEAST = 15


def _names(batch: pa.RecordBatch) -> list[str | None]:
    return batch.column(0).cast(pa.string()).to_pylist()


@arrow_udtf(returnType="session_id string, start long, end long, length long")
class SessionRanges:
    """Maximal runs of set flags: (key, seq, flag); null flags are not set."""

    def __init__(self):
        self.open: tuple[str | None, int, int] | None = None

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        done = []
        flags = batch.column(2).cast(pa.bool_()).to_pylist()
        for key, seq, flag in zip(_names(batch), batch.column(1).to_pylist(), flags):
            if self.open and (not flag or self.open[0] != key):
                done.append(self.open)
                self.open = None
            if flag:
                self.open = (key, self.open[1] if self.open else seq, seq + 1)
        yield from self._told(done)

    def terminate(self) -> Iterator[pa.Table]:
        yield from self._told([self.open] if self.open else [])

    @staticmethod
    def _told(found: list[tuple[str | None, int, int]]) -> Iterator[pa.Table]:
        if found:
            keys, starts, ends = zip(*found)
            yield pa.table({"session_id": pa.array(keys, pa.string()), "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64()), "length": pa.array([b - a for a, b in zip(starts, ends)], pa.int64())})


class _Whole:
    """Holds the column of one session until its end."""

    def __init__(self):
        self.parts: list[pa.RecordBatch] = []
        self.options: tuple = ()

    def _take(self, batch: pa.RecordBatch, *options: pa.Array) -> None:
        self.parts.append(batch)
        self.options = tuple(o[0].as_py() for o in options)

    def _session(self) -> tuple[pa.Array, np.ndarray, np.ndarray] | None:
        if not sum(p.num_rows for p in self.parts):
            return None
        whole = pa.Table.from_batches(self.parts).combine_chunks()
        numbers = whole.column(2).cast(pa.float64()).to_numpy()
        return whole.column(0).cast(pa.string()), whole.column(1).cast(pa.int64()).to_numpy(), np.nan_to_num(numbers)


@arrow_udtf(returnType="session_id string, seq long, filtered double")
class SessionLowpass(_Whole):
    """Zero-phase low-pass of (key, seq, value), cut at ``high`` Hz; null for sessions of 15 samples or fewer."""

    def eval(self, batch: pa.RecordBatch, high: pa.Array) -> Iterator[pa.Table]:
        self._take(batch, high)
        yield from ()

    def terminate(self) -> Iterator[pa.Table]:
        if found := self._session():
            keys, seq, x = found
            out = pa.array(filter_data(x, "low", high=float(self.options[0]))) if len(x) > LEAST else pa.nulls(len(x), pa.float64())
            yield pa.table({"session_id": keys, "seq": seq, "filtered": out})


@arrow_udtf(returnType="session_id string, seq long, height double")
class SessionPeaks(_Whole):
    """Peaks of (key, seq, value) of at least ``least``, more than ``distance`` samples apart."""

    def eval(self, batch: pa.RecordBatch, least: pa.Array, distance: pa.Array) -> Iterator[pa.Table]:
        self._take(batch, least, distance)
        yield from ()

    def terminate(self) -> Iterator[pa.Table]:
        if found := self._session():
            keys, seq, x = found
            at = detect_peaks(x, float(self.options[0]), int(self.options[1]))
            yield pa.table({"session_id": keys.take(pa.array(at, pa.int64())), "seq": seq[at], "height": x[at]})


FUNCTIONS = {"session_ranges": SessionRanges, "session_lowpass": SessionLowpass, "session_peaks": SessionPeaks}


def register(spark: SparkSession) -> None:
    """Makes the functions callable from SQL."""
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
