"""Byte-level BPE: encoding in overlapping chunks, decoding by raw bytes.

Every text is cut into chunks of CHUNK characters that overlap.  Each chunk is pre-tokenised on its own, from a
place that may lie inside a pre-token.  The pattern looks only ahead, so where two
neighbouring chunks have a common boundary they agree from there on: the later chunk takes
over at the first common boundary of the overlap.  Where an overlap has none (a run longer
than the overlap), the text from the last sure boundary is pre-tokenised on until it meets
a boundary of a later chunk.  The pieces between these meeting places are encoded one by one,
as in the whole text.

Texts of up to DEALT characters have their chunks cut, stitched and encoded in their task.  Longer texts
travel as chunks of DEALT characters, so that a very long document is pre-tokenised and encoded by many
tasks; there each chunk sends the ids of its pre-tokens along, and stitching picks them.

Edge cases: a null text counts as empty (no ids).  Null ids and repeated rows give a result
for each row, at any length: rows of long texts are numbered and written before they are cut
to chunks, and stitched by that number.  An empty table gives an empty result.
Input columns other than the two named are not carried.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import tables

CHUNK, OVERLAP = 512, 64
DEALT, DEALT_OVERLAP = 65_536, 1_024
CODES = "doc_id long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Ranks of a vocabulary file with its pattern."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.bytes = [b""] * size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.names = list(map(str, range(size)))

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        named = ",".join(map(self.names.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(named).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


def boundaries(pattern, text: str, at: int, end: int) -> list[int]:
    """Sure boundaries of the pre-tokens of text[at:end], from ``at`` on.

    A pre-token that ends within a character of the end is not sure (the longest
    contraction looks two characters ahead), unless the text ends there.
    """
    own = text[at:end]
    out = list(accumulate(map(len, pattern.findall(own)), initial=at))
    if out[-1] != at + len(own):  # not all characters belong to a pre-token
        out = [at, *(at + m.end() for m in pattern.finditer(own))]
    if end < len(text):
        while len(out) > 1 and out[-1] > end - 2:
            out.pop()
    return out


def cuts(pattern, text: str, chunk: int, overlap: int) -> list[int]:
    """Boundaries of the whole text, about one a chunk, where neighbouring chunks meet; and both ends."""
    found, n = [0], len(text)
    sure = boundaries(pattern, text, 0, min(n, chunk + overlap))
    k = 1
    while k * chunk < n:
        begin = k * chunk
        mine = boundaries(pattern, text, begin, min(n, begin + chunk + overlap))
        met = set(mine)
        meet = next((p for p in sure[bisect_left(sure, begin) :] if p in met), None)
        pos = sure[-1]
        # No common boundary: pre-tokenise on from the last sure one, until this chunk or a later one is met.
        while meet is None and pos < begin + chunk and pos < n:
            m = pattern.search(text, pos)
            pos = m.end() if m else n
            if pos >= begin and pos in met:
                meet = pos
        if meet is None:
            sure = [pos]
        else:
            found.append(meet)
            sure = mine[bisect_left(mine, meet) :]
        k += 1
    if found[-1] != n:
        found.append(n)
    return found


def chunk_tokens(codec: Codec, pattern, text: str, whole: bool) -> tuple[list[int], list[int], list[int]]:
    """Starts, id counts and ids of a chunk's sure pre-tokens."""
    edges = boundaries(pattern, text if whole else text + "..", 0, len(text))
    known: dict[str, list[int]] = {}
    starts, counts, ids = edges[:-1], [], []
    for a, b in zip(edges, edges[1:]):
        token = text[a:b]
        own = known.get(token)
        if own is None:
            own = known[token] = codec.encode(token)
        counts.append(len(own))
        ids += own
    return starts, counts, ids


def stitch(codec: Codec, pattern, chunks: list[tuple[str, list[int], list[int], list[int]]], chunk: int) -> list[int]:
    """Ids of the whole text from its chunks (slice, starts, counts, ids), starts absolute."""
    text = "".join(c[0][:chunk] for c in chunks[:-1]) + chunks[-1][0]
    known = [dict(zip(s, range(len(s)))) for _, s, _, _ in chunks]
    at = [np.concatenate(([0], np.cumsum(c))).astype(int) for _, _, c, _ in chunks]
    out: list[int] = []
    k, pos = 0, 0
    while pos < len(text):
        _, starts, _, ids = chunks[k]
        first = known[k].get(pos)
        if first is not None:
            meet = None
            if k + 1 < len(chunks):
                begin = bisect_left(starts, (k + 1) * chunk, first)
                meet = next((p for p in starts[begin:] if p in known[k + 1]), None)
            last = known[k][meet] if meet is not None else len(starts)
            out += ids[at[k][first] : at[k][last]]
            if meet is not None:
                k, pos = k + 1, meet
                continue
            # No common boundary: go on from the end of this chunk's last sure pre-token.
            pos = pattern.search(text, starts[-1]).end()
        while pos < len(text):
            j = next((j for j in range(min(pos // chunk, len(chunks) - 1), k, -1) if pos in known[j]), None)
            if j is not None:
                k = j
                break
            end = pattern.search(text, pos).end()
            out += codec.encode(text[pos:end])
            pos = end
    return out


def encode_in_chunks(codec: Codec, pattern, text: str, chunk: int, overlap: int) -> list[int]:
    """Ids of a text from its pieces between meeting places of overlapping chunks."""
    at = cuts(pattern, text, chunk, overlap)
    return list(chain.from_iterable(codec.encode(text[a:b]) for a, b in zip(at, at[1:])))


def _direct(path: str, pattern: str, chunk: int, overlap: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        codec, find = Codec(path, pattern), regex.compile(pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                coded = (encode_in_chunks(codec, find, t or "", chunk, overlap) for t in part.column(1).to_pylist())
                yield _rows(codec, part.column(0), coded, digest)

    return run


def _rows(codec: Codec, keys: pa.Array, coded, digest: bool) -> pa.RecordBatch:
    if not digest:
        return pa.RecordBatch.from_arrays([keys, pa.array([np.array(ids, "<u4").tobytes() for ids in coded], pa.binary())], ["doc_id", "ids"])
    found = [codec.digests(ids) for ids in coded]
    n, ids, decoded = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _chunked(path: str, pattern: str, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        codec, find = Codec(path, pattern), regex.compile(pattern)
        for batch in batches:
            for number, doc, k, text, last in zip(*(batch.column(i).to_pylist() for i in range(5))):
                starts, counts, ids = chunk_tokens(codec, find, text, last)
                row = ([number], [doc], [k], [text], [[s + k * chunk for s in starts]], [counts], [ids])
                types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), *(pa.list_(pa.int32()),) * 3)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], ["row", "doc_id", "k", "slice", "starts", "counts", "ids"])

    return run


def _stitched(path: str, pattern: str, chunk: int, digest: bool):
    def run(table: pa.Table) -> pa.Table:
        import regex

        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("k", "slice", "starts", "counts", "ids"))))
        codec = Codec(path, pattern)
        ids = stitch(codec, regex.compile(pattern), [r[1:] for r in rows], chunk)
        return pa.Table.from_batches([_rows(codec, pa.array(table.column("doc_id").to_pylist()[:1], pa.int64()), [ids], digest)])

    return run


def _coded(docs: DataFrame, path: str, pattern: str, sizes: tuple[int, int], dealt: tuple[int, int], digest: bool) -> DataFrame:
    schema, (chunk, overlap) = DIGESTS if digest else CODES, dealt
    own = docs.select(F.col("doc_id").cast("long"), "text")
    size = F.coalesce(F.length("text"), F.lit(0))
    short = own.where(size <= chunk).mapInArrow(tables.lean_batches(_direct(path, pattern, *sizes, digest)), schema)
    ks = F.explode(F.sequence(F.lit(0), ((F.length("text") - 1) / chunk).cast("int")))
    long = tables.cut(own.where(size > chunk).withColumn("row", F.monotonically_increasing_id()))
    slices = long.select("row", "doc_id", ks.alias("k"), "text").select(
        "row", "doc_id", "k", F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("slice"), (F.length("text") <= F.col("k") * chunk + chunk + overlap).alias("last")
    )
    spread = slices.repartition("row", "k")
    parts = spread.mapInArrow(tables.lean_batches(_chunked(path, pattern, chunk)), "row long, doc_id long, k int, slice string, starts array<int>, counts array<int>, ids array<int>")
    return short.unionByName(parts.groupBy("row").applyInArrow(tables.lean(_stitched(path, pattern, chunk, digest)), schema))


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, sizes: tuple[int, int] = (CHUNK, OVERLAP), dealt: tuple[int, int] = (DEALT, DEALT_OVERLAP)) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian 32-bit) of each text.

    ``sizes`` and ``dealt`` are (chunk, overlap) inside a task and for texts that many tasks share.
    """
    return _coded(docs, path, pattern, sizes, dealt, False)


def decode(codes: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and ``data``, the raw bytes, of encoded texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern)
        for batch in batches:
            data = [codec.decode(np.frombuffer(ids or b"", "<u4").tolist()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return codes.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def encode_digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, sizes: tuple[int, int] = (CHUNK, OVERLAP), dealt: tuple[int, int] = (DEALT, DEALT_OVERLAP)) -> DataFrame:
    """Counts and digests of the ids and of the decoded bytes, made where the ids are."""
    return _coded(docs, path, pattern, sizes, dealt, True)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of their decoding, for every document."""
    return encode_digests(tables.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
ORACLE_SQL: dict[str, str] = {}
