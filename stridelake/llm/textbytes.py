"""Numpy kernels over the UTF-8 bytes of many texts at once.

A batch of texts is one byte buffer with offsets, taken from the Arrow column without a
copy.  Rolling and word hashes are 64-bit, vectorised over the whole buffer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
#: A random 64-bit value for each byte, so that hashes do not inherit the structure of text.
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
#: Bytes that end a word: space and the controls from tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n+1) of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32, count=n + 1 + column.offset)[column.offset :].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of about ``limit`` bytes; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width``-byte string; entry i belongs to the string that starts at i."""
    if len(data) < width:
        return np.zeros(0, U64)
    power, have, out, at = BYTE_VALUES[data], 1, None, 0
    factor, left = _BASE, width
    # Doubling: `power` holds hashes of `have` bytes; the bits of `width` are put together.
    with np.errstate(over="ignore"):
        while True:
            if left & 1:
                if out is None:
                    out, at = power, have
                else:
                    n = len(data) - at - have + 1
                    out = out[:n] * factor + power[at : at + n]
                    at += have
            left >>= 1
            if not left:
                break
            n = len(data) - 2 * have + 1
            power = power[:n] * factor + power[have : have + n]
            factor, have = factor * factor, 2 * have
    return mix(out[: len(data) - width + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, entry i for those from i on."""
    if len(x) < width:
        return x[:0]
    have, low = 1, x
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(x) - width + 1], low[rest : rest + len(x) - width + 1])


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, inverse powers): range hashes of any [s, e) by :func:`range_hash`."""
    with np.errstate(over="ignore"):
        powers = _powers(len(data) + 1)
        prefix = np.empty(len(data) + 1, U64)
        prefix[0] = 0
        np.cumsum(BYTE_VALUES[data] * powers[0][:-1], out=prefix[1:])
    return prefix, powers[1]


#: Bytes whose prefix sums and powers are held at once (a longer string has its own).
HASHED_AT_ONCE = 1 << 18
_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each; the usual number is kept."""
    have = max(_cache, default=0)
    if have < n:
        size = max(HASHED_AT_ONCE + 1, n)
        inverse = U64(pow(int(_BASE), -1, 2**64))
        with np.errstate(over="ignore"):
            up, down = np.full(size, _BASE), np.full(size, inverse)
            up[0] = down[0] = 1
            np.cumprod(up, out=up)
            np.cumprod(down, out=down)
        if size > HASHED_AT_ONCE + 1:
            return up[:n], down[:n]
        _cache[size] = (up, down)
        have = size
    up, down = _cache[have]
    return up[:n], down[:n]


def range_hash(prefix: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end), independent of where they stand."""
    with np.errstate(over="ignore"):
        return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def string_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each string [start, end), wherever it stands; starts and ends rise."""
    out, i = np.empty(len(start), U64), 0
    while i < len(start):
        base = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, base + HASHED_AT_ONCE, "right")))
        prefix, inverse = prefix_sums(data[base : int(end[j - 1])])
        out[i:j] = range_hash(prefix, inverse, start[i:j] - base, end[i:j] - base)
        i = j
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words; a row's end also ends a word."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~IS_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`words`, with a 64-bit hash of each word (ASCII letters lower-cased)."""
    start, end, row = words(data, offsets)
    if not len(start):
        return start, end, row, np.zeros(0, U64)
    return start, end, row, string_hashes(LOWER[data] if lower else data, start, end)


def shingles(row: np.ndarray, hashes: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each window of ``width`` words inside a row.

    A row with fewer words has its whole sequence as the one shingle; a row without words
    has none.
    """
    counts = np.bincount(row, minlength=n_rows)
    out_row, out_hash = np.zeros(0, np.int64), np.zeros(0, U64)
    with np.errstate(over="ignore"):
        if len(row) >= width:
            same = row[: len(row) - width + 1] == row[width - 1 :]
            at = np.flatnonzero(same)
            h = np.zeros(len(at), U64)
            for j in range(width):
                h = h * _BASE + hashes[at + j]
            out_row, out_hash = row[at], mix(h)
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            first = np.concatenate(([0], np.cumsum(counts)))[short]
            h = counts[short].astype(U64) * U64(0xA0761D6478BD642F)
            for j in range(width - 1):
                more = j < counts[short]
                h[more] = h[more] * _BASE + hashes[first[more] + j]
            out_row, out_hash = np.concatenate((out_row, short)), np.concatenate((out_hash, mix(h)))
    return out_row, out_hash


def distinct_pairs(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), sorted by row and then hash."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return row[keep], hashes[keep]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def planes(numbers: np.ndarray, kind: str) -> bytes:
    """The numbers' first bytes, then their second bytes and so on: high bytes compress to nothing."""
    return np.ascontiguousarray(numbers.astype(kind)[:, None].view(np.uint8).T).tobytes()


def of_planes(data: np.ndarray, kind: str) -> np.ndarray:
    """The numbers that :func:`planes` was given."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(width, -1).T).view(kind).ravel()


def in_order(table: pa.Table) -> pa.Array:
    """Row order of a block by id and then text, the same whatever order the rows came in."""
    return pc.sort_indices(table.select(["doc_id", "text"]), [("doc_id", "ascending"), ("text", "ascending")])
