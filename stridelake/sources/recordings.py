"""The named format ``recordings``: uploaded 40-byte records as a batch and a stream.

``spark.read.format("recordings").load(folder)`` reads files named ``<session>_<millis>``.
The files of a session are one stretch of bytes in the order of their times, so a record may
be split over files.  Partitions are cut on record edges of that stretch, whatever the files'
sizes; planning looks at names and sizes only, and a task reads its own byte ranges.

As a stream, a batch has the records that its new files complete.  What has been read is
known from the time and name of the last file, so a replay gives the same batches; files
must arrive in the order of the times in their names.

Times are as recorded: :func:`stridelake.sources.records.repair_times` mends a session.
Bytes after the last whole record are not read.  Folders may be any that Arrow's file
systems open; the option ``recordsPerPartition`` bounds a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from stridelake.sources.records import EPOCH_MS, RECORD, SCALE, SENSORS

NAME = re.compile(r"^(.*)_(\d+)$")
#: Records of a task and of an Arrow batch.
PER_PARTITION, PER_BATCH = 200_000, 20_000
COLUMNS = ["epoch_ms", *(f"{c}" for k in range(3) for c in (f"static_{k}", *(f"acc_{k}_{x}" for x in "xyz"), *(f"quat_{k}_{x}" for x in "wxyz")))]
SCHEMA = "session_id string, seq long, epoch_ms long, " + ", ".join(f"{c} {'int' if c.startswith('static') else 'double'}" for c in COLUMNS[1:])


@dataclass(frozen=True)
class File:
    session: str
    millis: int
    path: str
    size: int


@dataclass(frozen=True)
class Piece(InputPartition):
    """Records ``first`` to ``stop`` of a session, and the files that hold them with the place of their first byte."""

    session: str
    first: int
    stop: int
    files: tuple[tuple[str, int, int], ...]


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    """Big-endian numbers of the last axis' bytes."""
    out = np.zeros(rows.shape[:-1], np.int64)
    for k in range(rows.shape[-1]):
        out = out << 8 | rows[..., k]
    return out


def fields(packed: np.ndarray) -> np.ndarray:
    """Three signed 13-bit fields of each 5-byte number, times 8."""
    parts = np.stack([packed >> shift & 8191 for shift in (26, 13, 0)], -1)
    return (parts - 8192 * (parts >= 4096)) * 8


def columns_of(rows: np.ndarray) -> list[pa.Array]:
    """Columns of records (n x 40 bytes), in the order of COLUMNS."""
    rows = rows.astype(np.int64)
    out = [pa.array(whole_numbers(rows[:, :5]) + EPOCH_MS)]
    for at in SENSORS:
        flag = rows[:, at]
        factor = np.where(flag >> 3 & 10 == 2, 4.0, 1.0)[:, None]
        acc, turn = (fields(whole_numbers(rows[:, a : a + 5])) for a in (at + 1, at + 6))
        turn = turn / SCALE
        square = (turn * turn).sum(1)
        scalar = np.sqrt(np.maximum(1 - square, 0))
        turn = np.where((square > 1)[:, None], turn / np.sqrt(np.maximum(square, 1))[:, None], turn)
        out.append(pa.array((flag >> 3 & 1).astype(np.int32)))
        out += [pa.array(c) for c in (acc * factor).T]
        out += [pa.array(c) for c in (scalar, *turn.T)]
    return out


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def listed(folder: str) -> list[File]:
    """Recordings of a folder by time and name."""
    system, path = opened(folder)
    found = []
    for info in system.get_file_info(fs.FileSelector(path)):
        named = NAME.match(info.base_name)
        if info.type == fs.FileType.File and named:
            found.append(File(named[1], int(named[2]), info.path, info.size))
    return sorted(found, key=lambda f: (f.millis, f.path))


def pieces(files: list[File], known: int, size: int) -> list[Piece]:
    """Partitions of the records that ``files[known:]`` complete, cut at multiples of ``size`` records of a session."""
    sessions: dict[str, list[File]] = {}
    for f in files:
        sessions.setdefault(f.session, []).append(f)
    before: dict[str, int] = {}
    for f in files[:known]:
        before[f.session] = before.get(f.session, 0) + f.size
    out = []
    for session, own in sessions.items():
        ends = np.cumsum([f.size for f in own])
        first, stop = before.get(session, 0) // RECORD, int(ends[-1]) // RECORD
        for a in range(first, stop, size):
            b = min(a + size, stop)
            low, high = np.searchsorted(ends, a * RECORD, "right"), np.searchsorted(ends, b * RECORD, "left")
            out.append(Piece(session, a, b, tuple((f.path, int(end) - f.size, f.size) for f, end in zip(own[low : high + 1], ends[low : high + 1]))))
    return out


def read_piece(folder: str, piece: Piece) -> Iterator[pa.RecordBatch]:
    system, _ = opened(folder)
    for a in range(piece.first, piece.stop, PER_BATCH):
        b = min(a + PER_BATCH, piece.stop)
        data = []
        for path, begin, size in piece.files:
            low, high = max(a * RECORD - begin, 0), min(b * RECORD - begin, size)
            if low < high:
                with system.open_input_file(path) as f:
                    data.append(f.read_at(high - low, low))
        rows = np.frombuffer(b"".join(data), np.uint8).reshape(-1, RECORD)
        names = pa.array([piece.session] * len(rows), pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array(np.arange(a, b)), *columns_of(rows)], ["session_id", "seq", *COLUMNS])


class _Reader:
    def __init__(self, folder: str, size: int):
        self.folder, self.size = folder, size

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return read_piece(self.folder, partition)


class BatchReader(_Reader, DataSourceReader):
    def partitions(self) -> Sequence[Piece]:
        return pieces(listed(self.folder), 0, self.size) or [Piece("", 0, 0, ())]


class StreamReader(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"millis": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = listed(self.folder)
        return {"millis": files[-1].millis, "path": files[-1].path} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[Piece]:
        low, high = ((o["millis"], o["path"]) for o in (start, end))
        files = [f for f in listed(self.folder) if (f.millis, f.path) <= high]
        return pieces(files, sum((f.millis, f.path) <= low for f in files), self.size)

    def commit(self, end: dict) -> None:
        """Nothing is kept between batches."""


class Recordings(DataSource):
    """Register with ``spark.dataSource.register(Recordings)``."""

    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> str:
        return SCHEMA

    def _asked(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("recordsPerPartition", PER_PARTITION))

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(*self._asked())

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(*self._asked())
