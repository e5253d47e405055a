"""Ranges, merged blocks and anchored buckets of a stream, equal to the batch result.

Rows wait in list state until the watermark has passed them; then they are taken in the
order of ``seq`` and advance a small state: the open range, the open block and its open
bucket.  A silence longer than ``silence_ms`` ends a session of the key, whichever comes
first of the row after it and the event-time timer for it.  So the results depend on the
rows alone, not on how they were split into batches, as long as none comes later than the
watermark allows.

``ranges``: stretches of set flags.  ``blocks``: ranges with gaps of at most ``gap`` samples.
``buckets``: flagged samples of a block by ``width`` samples from its start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PENDING = "seq long, at long, flag boolean, signal double"
STATE = ", ".join(f"{c} {t}" for c, t in (
    ("last_at", "long"), ("start", "long"), ("end", "long"), ("total", "double"), ("block", "long"), ("block_end", "long"), ("n_ranges", "long"), ("block_total", "double"),
    ("bucket", "long"), ("bucket_n", "long"), ("bucket_total", "double"),
))
OUT = ("kind", "block", "start", "end", "n", "total")


@dataclass
class Open:
    """What is open of one key; -1 stands for nothing."""

    last_at: int = -1
    start: int = -1
    end: int = -1
    total: float = 0.0
    block: int = -1
    block_end: int = -1
    n_ranges: int = 0
    block_total: float = 0.0
    bucket: int = -1
    bucket_n: int = 0
    bucket_total: float = 0.0


@dataclass
class Fold:
    """Advances the state of one key row by row; ``out`` collects what has closed."""

    gap: int
    width: int
    silence_ms: int
    open: Open = field(default_factory=Open)
    out: list[tuple] = field(default_factory=list)

    def row(self, seq: int, at: int, flag: bool, signal: float) -> None:
        o = self.open
        if o.last_at >= 0 and at - o.last_at > self.silence_ms:
            self.close()
        o.last_at = at
        if not flag:
            self._end_range()
            return
        if o.start < 0:
            if o.block >= 0 and seq - o.block_end > self.gap:
                self._end_block()
            if o.block < 0:
                o.block = seq
            o.start, o.total = seq, 0.0
        o.end = seq + 1
        o.total += signal
        at_bucket = o.block + (seq - o.block) // self.width * self.width
        if o.bucket >= 0 and at_bucket != o.bucket:
            self._end_bucket(o.bucket + self.width)
        o.bucket = at_bucket
        o.bucket_n += 1
        o.bucket_total += signal

    def close(self) -> None:
        """Ends the key's session."""
        self._end_range()
        self._end_block()
        self.open.last_at = -1

    def _end_range(self) -> None:
        o = self.open
        if o.start >= 0:
            self.out.append(("range", o.block, o.start, o.end, o.end - o.start, o.total))
            o.block_end, o.n_ranges, o.block_total, o.start = o.end, o.n_ranges + 1, o.block_total + o.total, -1

    def _end_block(self) -> None:
        o = self.open
        if o.block >= 0:
            self._end_bucket(min(o.bucket + self.width, o.block_end))
            self.out.append(("block", o.block, o.block, o.block_end, o.n_ranges, o.block_total))
            o.block, o.block_end, o.n_ranges, o.block_total = -1, -1, 0, 0.0

    def _end_bucket(self, end: int) -> None:
        o = self.open
        self.out.append(("bucket", o.block, o.bucket, end, o.bucket_n, o.bucket_total))
        o.bucket, o.bucket_n, o.bucket_total = -1, 0, 0.0


class OnlineBlocks(StatefulProcessor):
    def __init__(self, key: str, gap: int, width: int, silence_ms: int):
        self.key, self.gap, self.width, self.silence_ms = key, gap, width, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PENDING)
        self.state = handle.getValueState("open", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [tuple(r) for part in rows for r in part[["seq", "at", "flag", "signal"]].itertuples(index=False)]
        yield self._advance(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def _advance(self, key: tuple, new: list[tuple], watermark: int) -> pd.DataFrame:
        rows = sorted([tuple(r) for r in self.pending.get()] + [(int(s), int(a), bool(f), float(x)) for s, a, f, x in new])
        # A row waits while an earlier one might still come, so rows go in the order of seq.
        ready = [r for r in rows if r[1] < watermark]
        waiting = [r for r in rows if r[1] >= watermark]
        held = self.state.get() if self.state.exists() else None
        fold = Fold(self.gap, self.width, self.silence_ms, Open(*held) if held else Open())
        for r in ready:
            fold.row(*r)
        o = fold.open
        if o.last_at >= 0 and not (waiting and waiting[0][1] - o.last_at <= self.silence_ms) and watermark - o.last_at > self.silence_ms:
            fold.close()
        if waiting:
            self.pending.put(waiting)
        else:
            self.pending.clear()
        if o.last_at >= 0:
            self.state.update((o.last_at, o.start, o.end, o.total, o.block, o.block_end, o.n_ranges, o.block_total, o.bucket, o.bucket_n, o.bucket_total))
        else:
            self.state.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = [waiting[0][1] + 1] if waiting else []
        due += [o.last_at + self.silence_ms + 1] if o.last_at >= 0 else []
        if due:
            self.handle.registerTimer(max(min(due), watermark + 1))
        return pd.DataFrame([(*key, *r) for r in fold.out], columns=[self.key, *OUT])

    def close(self) -> None:
        """Nothing is held beyond the state."""


def online_blocks(stream: DataFrame, at: str, delay: str, gap: int, width: int, silence_ms: int, key: str = "session_id") -> DataFrame:
    """Ranges, blocks and buckets (``kind, block, start, end, n, total``) of rows with ``seq``, ``flag`` and ``signal``.

    ``at`` is the event time; ``seq`` rises with it within a key.  The session needs the
    RocksDB state store.
    """
    if stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        raise ValueError(f"spark.sql.streaming.stateStore.providerClass must be {PROVIDER}")
    kind = dict(stream.dtypes)[key]
    rows = stream.withWatermark(at, delay).select(key, F.col(at).alias("_time"), "seq", F.unix_millis(at).alias("at"), F.coalesce("flag", F.lit(False)).alias("flag"), F.coalesce(F.col("signal").cast("double"), F.lit(0.0)).alias("signal"))
    schema = f"{key} {kind}, kind string, block long, start long, end long, n long, total double"
    return rows.groupBy(key).transformWithStateInPandas(OnlineBlocks(key, gap, width, silence_ms), schema, "Append", "EventTime")
