"""Exact substring dedup by the interval tree of an enhanced suffix array.

Every string of ``min_bytes`` bytes that also starts in a document with a smaller id goes.

The corpus is dealt in blocks of whole documents.  A block cuts its texts into fragments:
runs of windows (strings of ``min_bytes``) that share their smallest k-mer hash.  Equal
windows have equal smallest hashes, so they meet in the bucket of that hash whatever
document they stand in.  Blocks first announce their hashes, and the buckets answer with a
bit for each that another block has too.  Only fragments of such hashes (or of a hash that
the block itself has in several fragments) are sent, each distinct one once, with its
smallest document: a passage that a third of all documents repeat reaches its bucket once a
block.

A bucket builds the suffix array of the windows that occur in two fragments or more, with
the lengths of common prefixes, and scans it with a stack for the tree of common-prefix
intervals.  An interval whose occurrences are preceded by different bytes (or by an edge)
is a maximal repeat: it is told to all blocks that hold an occurrence, with its length and
its first document.  Windows that are always preceded by the same byte are left out before
the sort, since their repeats extend to the left.  Blocks then mark the bytes.

The texts are shuffled once (all passes read the same exchange).  All passes are
deterministic, so lost executors only cost their tasks.

Edge cases: a null text counts as empty.  Matches never cross documents; rows with one id
never remove each other; a null id counts as larger than all others.  Overlaps of a text with itself do not
count.  Very long texts stay whole in their block.  An empty table gives an empty result.
Input columns other than the two named are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm import tables, textbytes
from stridelake.llm.textbytes import U64

MIN_BYTES, SEED = 50, 20
BLOCK_BYTES, BUCKETS_A_BLOCK, MAX_WINDOWS = 2 << 20, 2, 64
LAST = 2**63 - 1
HEARD = "bucket int, block int, names binary"
SHARED = "block int, bucket int, bits binary"
SENT = "bucket int, block int, at binary, lens binary, docs binary, content binary"
TOLD = "block int, bucket int, place binary, offset binary, size binary, first binary, repeat binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
OCCURRENCES = "repeat_id long, doc_id long, start long, length long, first_doc_id long"


def runs(data: np.ndarray, offsets: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and smallest hash of the runs of windows that share it."""
    n = max(len(data) - width + 1, 0)
    low = textbytes.sliding_min(textbytes.rolling(data, seed), width - seed + 1)[:n]
    valid = np.zeros(n + 1, np.int32)
    whole = np.diff(offsets) >= width
    np.add.at(valid, offsets[:-1][whole], 1)
    np.add.at(valid, offsets[1:][whole] - width + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    begins = valid.copy()
    begins[1:] &= ~(valid[:-1] & (low[1:] == low[:-1]))
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = valid[cuts]
    start = np.flatnonzero(begins)
    if not len(start):
        return start, start, low[:0]
    stops = np.concatenate((np.flatnonzero(valid & ~np.concatenate((valid[1:], [False]))) + 1, cuts))
    edges = np.unique(np.concatenate((start, stops)))
    count = edges[np.minimum(np.searchsorted(edges, start, "right"), len(edges) - 1)] - start
    return start, count, low[start]


class Fragments:
    """Distinct fragments of a block and all their occurrences."""

    def __init__(self, docs: np.ndarray, data: np.ndarray, offsets: np.ndarray, width: int, seed: int, buckets: int):
        start, count, low = runs(data, offsets, width, seed)
        # Long runs (periodic text) are cut; which bucket a window meets in does not change.
        parts = -(-count // MAX_WINDOWS)
        shift = textbytes.ragged(np.zeros(len(start), np.int64), parts)
        rest = np.repeat(count, parts) - shift * MAX_WINDOWS
        self.start = np.repeat(start, parts) + shift * MAX_WINDOWS
        self.size = np.minimum(rest, MAX_WINDOWS) + width - 1
        self.doc = docs[np.searchsorted(offsets, self.start, "right") - 1]
        names = textbytes.string_hashes(data, self.start, self.start + self.size)
        _, first, which = np.unique(names, return_index=True, return_inverse=True)
        order = np.argsort(first, kind="stable")  # distinct fragments in text order
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.which = rank[which]
        self.first = first[order]  # index of the first occurrence; documents are sorted
        self.low = np.repeat(low, parts)[self.first]
        bucket = (self.low % U64(buckets)).astype(np.int32)
        self.order = np.argsort(bucket, kind="stable")  # distinct fragments by bucket
        self.bucket = bucket[self.order]


def _hash_names(low: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes as (bucket, 32 bits of the rest), sorted."""
    low = np.unique(low)
    bucket, name = (low % U64(buckets)).astype(np.int64), (low // U64(buckets) & U64(0xFFFFFFFF)).astype(np.int64)
    both = np.unique((bucket << 32) | name)
    return both >> 32, both & 0xFFFFFFFF


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Documents of a block in order of their ids: ids, bytes, offsets."""
    order = textbytes.in_order(table)
    data, offsets = textbytes.buffer_of(table.column("text").take(order))
    return table.column("doc_id").take(order).to_numpy(), data, offsets, order


def _announce(width: int, seed: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        _, data, offsets, _ = _block(table)
        bucket, name = _hash_names(runs(data, offsets, width, seed)[2], buckets)
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else []
        block = table.column("block")[0].as_py()
        rows = [(int(bucket[a]), block, name[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
        columns = list(zip(*rows)) or [()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "block", "names"])

    return run


def _common(table: pa.Table) -> pa.Table:
    """A bit for each announced hash: does another block have it too?"""
    names = [np.frombuffer(x.as_py(), "<u4") for x in table.column("names")]
    _, which, times = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
    bits = np.split(times[which] > 1, np.cumsum([len(x) for x in names])[:-1])
    return pa.table([table.column("block"), table.column("bucket"), pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())], names=["block", "bucket", "bits"])


def _send(width: int, seed: int, buckets: int):
    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        docs, data, offsets, _ = _block(table)
        f = Fragments(docs, data, offsets, width, seed, buckets)
        bucket, name = _hash_names(f.low, buckets)
        order = np.argsort(shared.column("bucket").to_numpy(), kind="stable").tolist()
        bits = shared.column("bits").to_pylist()
        counts = np.bincount(bucket, minlength=buckets)
        told = [np.unpackbits(np.frombuffer(bits[i], np.uint8), count=int(counts[shared.column("bucket")[i].as_py()])) for i in order]
        known = np.concatenate(told).astype(bool) if told else np.zeros(0, bool)
        mine = (f.low[f.order] // U64(buckets) & U64(0xFFFFFFFF)).astype(np.int64) | (f.bucket.astype(np.int64) << 32)
        at = np.searchsorted((bucket << 32) | name, mine)
        times = np.bincount(at, minlength=len(name))
        begin = np.searchsorted(f.bucket, np.arange(buckets + 1))
        rows: list[tuple] = []
        block = table.column("block")[0].as_py()
        wanted = known[at] | (times[at] > 1) if len(at) else at.astype(bool)
        for k in np.unique(f.bucket[wanted]):
            place = np.flatnonzero(wanted[begin[k] : begin[k + 1]])
            x = f.first[f.order[begin[k] + place]]
            content = data[textbytes.ragged(f.start[x], f.size[x])].tobytes()
            rows.append((int(k), block, press(np.diff(place, prepend=0).astype("<i4").tobytes()), f.size[x].astype(np.uint8).tobytes(), press(np.diff(f.doc[x], prepend=0).astype("<i8").tobytes()), press(content)))
        columns = list(zip(*rows)) or [()] * 6
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), *(pa.binary(),) * 4))], names=[x.split()[0] for x in SENT.split(", ")])

    return run


def interval_tree(lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, end) of the common-prefix intervals of a suffix array; lcp[i] is that of i-1 and i."""
    out, stack = [], []  # of (length, first)
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            out.append((length, first, i))
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))
    return out


def maximal_repeats(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray, width: int, seed: int) -> list[np.ndarray]:
    """Columns fragment, offset, size, first document, repeat: occurrences of the maximal repeats of distinct fragments.

    The fragments are data[start : start + size]; ``docs`` has the smallest document of each.
    """
    none = [np.zeros(0, np.int64)] * 5
    windows = sizes - width + 1
    # Only fragments that share their smallest k-mer hash with another can share a window.
    seeds = textbytes.rolling(data, seed)
    low = np.minimum.reduceat(np.concatenate((seeds, np.zeros(seed, U64)))[textbytes.ragged(starts, np.full(len(starts), width - seed + 1))], np.arange(len(starts)) * (width - seed + 1)) if len(starts) else np.zeros(0, U64)
    _, which, times = np.unique(low, return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[which] > 1)
    if not len(some):
        return none
    fragment = np.repeat(some, windows[some])
    at = textbytes.ragged(starts[some], windows[some])
    names = textbytes.rolling(data, width)[at]
    order = np.argsort(names, kind="stable")
    names = names[order]
    new = np.concatenate(([True], names[1:] != names[:-1]))
    group = np.cumsum(new) - 1
    count = np.bincount(group)
    # The byte before an occurrence; an edge of its fragment differs from everything.
    edge = at == starts[fragment]
    before = np.where(edge, 0, data[np.maximum(at - 1, 0)].astype(np.int32) + 1)[order]
    heads = np.flatnonzero(new)
    low_b, high_b = np.minimum.reduceat(before, heads), np.maximum.reduceat(before, heads)
    diverse = (count > 1) & ((low_b == 0) | (low_b != high_b))
    chosen = order[diverse[group]]
    if not len(chosen):
        return none
    fragment, at = fragment[chosen], at[chosen]
    room = starts[fragment] + sizes[fragment] - at
    # Suffix array of the chosen windows: by eight-byte words up to the width, exactly.
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = [np.ascontiguousarray(padded[(at + k)[:, None] + np.arange(8)]).view(">u8").ravel().astype(U64) for k in [*range(0, width - 7, 8), width - 8]]
    rest = np.full(len(at), -1, np.int64)
    order = np.lexsort(words[::-1])
    same = np.ones(len(order) - 1, bool)
    for w in words:
        same &= w[order[1:]] == w[order[:-1]]
    lcp = np.zeros(len(order), np.int64)
    runs = np.cumsum(np.concatenate(([True], ~same))) - 1
    # Inside a run of equal windows the suffixes are ordered by what follows, to the fragment's end.
    tail = room - width
    size = np.bincount(runs)
    multiple = size[runs] > 1
    sub = order[multiple]
    if not len(sub):
        return none
    longest = int(tail[sub].max())
    follow = np.zeros((len(sub), longest + 1), np.uint8)
    for j in range(longest):
        inside = j < tail[sub]
        follow[inside, j] = data[at[sub[inside]] + width + j]
    fine = np.lexsort([*(follow[:, j] for j in range(longest - 1, -1, -1)), runs[multiple]])
    sub, follow, runs = sub[fine], follow[fine], runs[multiple][fine]
    rest = tail[sub]
    agree = follow[1:] == follow[:-1]
    common = np.minimum(np.where(agree.all(1), longest, agree.argmin(1)), np.minimum(rest[1:], rest[:-1]))
    lcp = np.concatenate(([0], np.where(runs[1:] == runs[:-1], width + common, 0)))
    edge = at[sub] == starts[fragment[sub]]
    before = np.where(edge, 0, data[np.maximum(at[sub] - 1, 0)].astype(np.int64) + 1)
    # The stack scan; left-extension diversity keeps the maximal ones.
    tree = np.array(interval_tree(lcp.tolist(), width), np.int64).reshape(-1, 3)
    if not len(tree):
        return none
    member = textbytes.ragged(tree[:, 1], tree[:, 2] - tree[:, 1])
    heads = np.concatenate(([0], np.cumsum(tree[:, 2] - tree[:, 1])[:-1]))
    low_b, high_b = np.minimum.reduceat(before[member], heads), np.maximum.reduceat(before[member], heads)
    first = np.minimum.reduceat(docs[fragment[sub[member]]], heads)
    keep = np.repeat((low_b == 0) | (low_b != high_b), tree[:, 2] - tree[:, 1])
    repeat = np.repeat(np.arange(len(tree)), tree[:, 2] - tree[:, 1])[keep]
    member = member[keep]
    own = fragment[sub[member]]
    return [own, at[sub[member]] - starts[own], tree[repeat, 0], first[repeat], repeat]


def _resolve(width: int, seed: int, every: bool):
    def run(table: pa.Table) -> pa.Table:
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        bucket = table.column("bucket")[0].as_py()
        order = np.argsort(table.column("block").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        blocks = table.column("block").to_numpy()
        lens = [np.frombuffer(x.as_py(), np.uint8).astype(np.int64) for x in table.column("lens")]
        docs = np.concatenate([np.cumsum(np.frombuffer(open_(x.as_py()), "<i8")) for x in table.column("docs")])
        data = np.frombuffer(b"".join(open_(x.as_py()) for x in table.column("content")), np.uint8)
        counts = np.array([len(x) for x in lens])
        size = np.concatenate(lens)
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        source = np.repeat(np.arange(len(blocks)), counts)
        place = np.concatenate([np.cumsum(np.frombuffer(open_(x.as_py()), "<i4").astype(np.int64)) for x in table.column("at")])
        # Equal fragments of different blocks are one, with their smallest document.
        names = textbytes.string_hashes(data, start, start + size)
        _, first, which, times = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
        least = np.full(len(first), LAST)
        np.minimum.at(least, which, docs)
        fragment, offset, length, doc, repeat = maximal_repeats(data, start[first], size[first], least, width, seed)
        shared = np.flatnonzero(times > 1)
        fragment = np.concatenate((fragment, shared))
        offset = np.concatenate((offset, np.zeros(len(shared), np.int64)))
        length = np.concatenate((length, size[first[shared]]))
        doc = np.concatenate((doc, least[shared]))
        repeat = np.concatenate((repeat, (int(repeat.max()) + 1 if len(repeat) else 0) + np.arange(len(shared))))
        # To all copies of the fragments.
        by = np.argsort(which, kind="stable")
        at = np.concatenate(([0], np.cumsum(times)))
        copies = by[textbytes.ragged(at[fragment], times[fragment])]
        each = np.repeat(np.arange(len(fragment)), times[fragment])
        if not every:
            told = doc[each] < docs[copies]
            copies, each = copies[told], each[told]
        order = np.argsort(source[copies], kind="stable")
        copies, each = copies[order], each[order]
        cuts = np.searchsorted(source[copies], np.arange(len(blocks) + 1))
        rows = []
        for i in range(len(blocks)):
            a, b = cuts[i], cuts[i + 1]
            if a < b:
                c, e = copies[a:b], each[a:b]
                rows.append((int(blocks[i]), bucket, place[c].astype("<i4").tobytes(), offset[e].astype(np.uint8).tobytes(), length[e].astype(np.uint8).tobytes(), doc[e].astype("<i8").tobytes(), ((np.int64(bucket) << 32) + repeat[e]).astype("<i8").tobytes() if every else b""))
        columns = list(zip(*rows)) or [()] * 7
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), *(pa.binary(),) * 5))], names=[x.split()[0] for x in TOLD.split(", ")])

    return run


def _told(table: pa.Table, f: Fragments) -> tuple[np.ndarray, ...]:
    """Distinct fragment, offset, size, first document and repeat of what a block was told."""
    begin = np.searchsorted(f.bucket, table.column("bucket").to_numpy())
    kinds = (("place", "<i4"), ("offset", "u1"), ("size", "u1"), ("first", "<i8"), ("repeat", "<i8"))
    read = {c: [np.frombuffer(x.as_py(), k).astype(np.int64) for x in table.column(c)] for c, k in kinds}
    flat = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in read.items()}
    own = f.order[flat["place"] + np.repeat(begin, [len(x) for x in read["place"]])] if len(flat["place"]) else flat["place"]
    return own, flat["offset"], flat["size"], flat["first"], flat["repeat"]


def _occurrences(f: Fragments, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence of told fragments: index of what was told, index of the occurrence."""
    by = np.argsort(f.which, kind="stable")
    times = np.bincount(f.which, minlength=len(f.first))
    at = np.concatenate(([0], np.cumsum(times)))
    return np.repeat(np.arange(len(own)), times[own]), by[textbytes.ragged(at[own], times[own])]


def _finish(width: int, seed: int, buckets: int, with_kept: bool, carry: tuple[str, ...]):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        docs, data, offsets, order = _block(table)
        f = Fragments(docs, data, offsets, width, seed, buckets)
        own, offset, size, first, _ = _told(told, f)
        each, occurrence = _occurrences(f, own)
        later = f.doc[occurrence] > first[each]
        each, occurrence = each[later], occurrence[later]
        again = np.flatnonzero(f.doc > f.doc[f.first[f.which]])  # repeats inside the block
        begin = np.concatenate((f.start[occurrence] + offset[each], f.start[again]))
        end = np.concatenate((f.start[occurrence] + offset[each] + size[each], f.start[again] + f.size[again]))
        depth = np.bincount(begin, minlength=len(data) + 1) - np.bincount(end, minlength=len(data) + 1)
        gone = np.cumsum(depth)[: len(data)] > 0
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(data)]
        rises[cuts] = gone[cuts]
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[offsets])
        removed, spans = total(gone), total(rises)
        kept_data = data[~gone].tobytes()
        ends = np.cumsum(np.diff(offsets) - removed).tolist()
        kept = [kept_data[a:b] for a, b in zip([0, *ends], ends)]
        columns = (docs, np.diff(offsets), removed, spans, [hashlib.sha256(k).hexdigest() for k in kept], kept if with_kept else [None] * len(kept))
        types = (*(pa.int64(),) * 4, pa.string(), pa.binary())
        other = [table.column(c).take(order) for c in carry]
        return pa.table([*(pa.array(c, t) for c, t in zip(columns, types)), *other], names=[*(x.split()[0] for x in RESULT.split(", ")), *carry])

    return run


def _list(width: int, seed: int, buckets: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        docs, data, offsets, _ = _block(table)
        f = Fragments(docs, data, offsets, width, seed, buckets)
        own, offset, size, first, repeat = _told(told, f)
        # Fragments that repeat in this block alone were told to no bucket: they are groups of the block.
        times = np.bincount(f.which, minlength=len(f.first))
        alone = np.flatnonzero((times > 1) & ~np.isin(np.arange(len(f.first)), own[(offset == 0) & (size == f.size[f.first[own]])]))
        block = table.column("block")[0].as_py() if len(table) else 0
        own, offset, size = np.concatenate((own, alone)), np.concatenate((offset, np.zeros(len(alone), np.int64))), np.concatenate((size, f.size[f.first[alone]]))
        first, repeat = np.concatenate((first, f.doc[f.first[alone]])), np.concatenate((repeat, -((np.int64(block) << 32) + alone) - 1))
        each, occurrence = _occurrences(f, own)
        place = f.start[occurrence] + offset[each]
        row = np.searchsorted(offsets, place, "right") - 1
        columns = (repeat[each], docs[row], place - offsets[row], size[each], first[each])
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in OCCURRENCES.split(", ")])

    return run


def _run(docs: DataFrame, key: str, text: str, width: int, seed: int, block_bytes: int, finish, schema: str, every: bool, carry: dict[str, str] = {}) -> DataFrame:  # noqa: B006
    own = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc_id"), F.col(text).alias("text"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(carry)))
    n = tables.block_count(own, "text", block_bytes)
    blocks = own.withColumn("block", tables.block_of(F.col("doc_id"), n))
    buckets = n * BUCKETS_A_BLOCK
    heard = blocks.groupBy("block").applyInArrow(tables.lean(_announce(width, seed, buckets)), HEARD)
    shared = heard.groupBy("bucket").applyInArrow(tables.lean(_common), SHARED)
    sent = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(tables.lean(_send(width, seed, buckets)), SENT)
    told = sent.groupBy("bucket").applyInArrow(tables.lean(_resolve(width, seed, every)), TOLD)
    done = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(tables.lean(finish(buckets)), schema)
    return done.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with the same columns, repeats removed from ``text``.

    A character that is cut through by a removed string goes as a whole.
    """
    carry = {f.name: f.dataType.simpleString() for f in docs.schema.fields if f.name not in (key, text)}
    names = tuple(f"_{i}" for i in range(len(carry)))
    schema = RESULT + "".join(f", {n} {t}" for n, t in zip(names, carry.values()))
    done = _run(docs, key, text, min_bytes, SEED, BLOCK_BYTES, lambda b: _finish(min_bytes, SEED, b, True, names), schema, False, carry)
    whole = F.expr("try_validate_utf8(cast(kept AS string))")
    text_ = F.coalesce(whole, F.regexp_replace(F.expr("make_valid_utf8(cast(kept AS string))"), "\ufffd", ""))
    out = {key: F.col("doc_id"), text: F.when(F.col("n_removed") >= 0, text_)} | {c: F.col(n) for c, n in zip(carry, names)}
    return done.select(*(out[f.name].cast(f.dataType).alias(f.name) for f in docs.schema.fields))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES, seed: int = SEED, block_bytes: int = BLOCK_BYTES, with_kept: bool = True) -> DataFrame:
    """Per document: lengths, removed spans, and the remaining bytes with their digest."""
    return _run(docs, key, text, min_bytes, seed, block_bytes, lambda b: _finish(min_bytes, seed, b, with_kept, ()), RESULT, False)


def _joined(rows: DataFrame) -> DataFrame:
    """Groups whose occurrences are each other's, shifted, and touch are one longer repeat.

    A group's shape is the multiset of its occurrences' documents and distances from its first
    occurrence; groups of one shape and one first document are merged along that document.
    """
    rows = tables.cut(rows)
    anchors = tables.cut(rows.groupBy("repeat_id").agg(F.min(F.struct("doc_id", "start")).alias("a"), F.count(F.lit(1)).alias("n"), F.max("length").alias("length")))
    placed = tables.skewed_join(rows, anchors.select("repeat_id", "a"), ["repeat_id"])
    shapes = placed.groupBy("repeat_id").agg(F.sum(F.xxhash64("doc_id", F.col("start") - F.col("a.start")).cast("decimal(38,0)")).alias("shape"))
    groups = anchors.join(shapes, "repeat_id").select("repeat_id", "n", "shape", "a.doc_id", "a.start", (F.col("a.start") + F.col("length")).alias("end"))
    w = Window.partitionBy("doc_id", "shape", "n").orderBy("start", "repeat_id")
    apart = F.col("start") > F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    numbered = groups.withColumn("_new", F.when(apart, 1).otherwise(0)).withColumn("_island", F.sum("_new").over(w))
    merged = numbered.groupBy("doc_id", "shape", "n", "_island").agg(F.min_by("repeat_id", F.struct("start", "repeat_id")).alias("repeat_id"), (F.max("end") - F.min("start")).alias("length"))
    out = tables.skewed_join(rows.drop("length"), tables.cut(merged.select("repeat_id", "length")), ["repeat_id"])
    return out.select("repeat_id", "doc_id", "start", "length", "first_doc_id")


def repeat_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES, seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Maximal repeat groups with all occurrences (also those inside one document), one row each.

    Repeats found within fragments are joined to their full lengths.
    """
    rows = _run(docs, key, text, min_bytes, seed, block_bytes, lambda b: _list(min_bytes, seed, b), OCCURRENCES, True)
    last = F.col("doc_id").isNull()
    return _joined(rows.withColumn("doc_id", F.when(last, F.lit(LAST)).otherwise(F.col("doc_id")))).withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes and the digest of what stays, for every document."""
    return dedup(tables.documents(spark, sf_dir), with_kept=False).drop("kept")


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE_SQL: dict[str, str] = {}
