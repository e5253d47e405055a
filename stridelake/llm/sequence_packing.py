"""Best-fit packing of tokenised documents into fixed sequences.

Item sizes are whole numbers up to the capacity, so an instance of any size is a histogram
of at most ``capacity`` counts.  On that histogram the Martello-Toth reduction fixes small
sets that dominate every alternative, for all equal items at once:

* an item that no other item fits beside stays alone;
* an item and its exact complement go together;
* where at most one more item fits beside an item, the largest one that fits goes there.

Best-fit decreasing packs what the reduction leaves, again for whole groups of equal bins.
The plan (patterns with multiplicities) then meets the pieces by their rank among pieces of
the same length; ranks are counted per (length, salt), so that a length which a third of all
pieces share is no hot group.  Only the histogram ever reaches the driver.

Edge cases: a null or empty text is the single end id.  Repeated rows are packed as often as
they come (their order among themselves is arbitrary).  An empty table packs into nothing.
Other input columns are not carried.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm import tables, textbytes

CAPACITY, END_ID = 2048, 0
#: Pieces of one length that are numbered in one task, about.
NUMBERED = 500_000
CONTROLS = re.compile("[\x1c-\x1f]")
#: Bytes of text that are split to words at once (a longer text stands alone).
SLICE_BYTES = 1 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class TextIds:
    """Ids of texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are those of
    its pieces in a row.  The pieces of many texts are merged in bulk: a byte-pair library
    that ranks tokens gets the same merges, with END standing for the end of a piece.  Words
    of other than Latin letters go through the tokenizer itself, and HERE keeps their place;
    so do whole texts that hold one of its added tokens, which may take white space with
    them.
    """

    END, HERE = "\x01", "\x02"
    OTHER = re.compile("[\x01\x02\u0250-\U0010ffff]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)))
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        self._bulk(spec["model"])

    def _bulk(self, model: dict) -> None:
        import tiktoken

        # The byte alphabet: printable bytes stand for themselves, the others for 256 and on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        end = self.END.encode()

        def raw(token: str) -> bytes:
            suffix = model["end_of_word_suffix"]
            last = token.endswith(suffix)
            return bytes(byte_of[c] for c in (token[: -len(suffix)] if last else token)) + end * last

        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + end: 256 + b for b in range(256)}
        for i, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(raw(left + right), 512 + i)
        self.encoding = tiktoken.Encoding("words", pat_str=f"[^{self.END}]*{self.END}", mergeable_ranks=ranks, special_tokens={})
        special = set(self.tokenizer.get_added_tokens_decoder())
        known = {raw(t): i for t, i in model["vocab"].items() if i not in special}
        self.id_of = np.zeros(max(ranks.values()) + 1, "<u4")
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            self.id_of[rank] = known.get(token, 0)
            self.ends[rank] = token.endswith(end)

        self.here = ranks[(self.HERE + self.END).encode()]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        pieces: list[str] = []
        counts, others = [], []
        for k, text in enumerate(texts):
            before = len(pieces)
            if self.takes_whole(text):
                out[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            elif text.isascii() and self.END not in text and self.HERE not in text or not self.OTHER.search(text):
                pieces += self.pieces.findall(text.lower())
            else:
                for word in text.split():
                    if self.OTHER.search(word):
                        pieces.append(self.HERE)
                        others.append(word)
                    else:
                        pieces += self.pieces.findall(word.lower())
            counts.append(len(pieces) - before)
        if not pieces:
            return out
        ranks = self.encoding.encode_to_numpy(self.END.join(pieces) + self.END)
        stop = np.concatenate(([0], np.flatnonzero(self.ends[ranks]) + 1))
        edges = stop[np.concatenate(([0], np.cumsum(counts)))].tolist()
        found = self.id_of[ranks]
        places = np.flatnonzero(ranks == self.here) if others else []
        known = dict.fromkeys(others)
        for word, e in zip(known, self.tokenizer.encode_batch_fast(list(known), add_special_tokens=False)):
            known[word] = np.array(e.ids, "<u4").tobytes()
        at = 0
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            if a == b:
                continue
            parts = []
            while at < len(places) and places[at] < b:
                parts += [found[a : places[at]].tobytes(), known[others[at]]]
                a, at = places[at] + 1, at + 1
            out[k] = b"".join((*parts, found[a:b].tobytes()))
        return out

    def takes_whole(self, text: str) -> bool:
        """Does the text hold an added token, or a control at which str.split() divides words although it is no white space to the tokenizer?"""
        return self.added.search(text) is not None or CONTROLS.search(text) is not None


_known: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """The worker's vocabulary; workers serve many tasks."""
    if path not in _known:
        _known[path] = TextIds(path)
    return _known[path]


def _pieces(vocabulary: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = text_ids(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            edges = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())))
            for first_row, stop in textbytes.pieces(edges, SLICE_BYTES):
                part = batch.slice(first_row, stop - first_row)
                out: list[tuple] = []
                for doc, own_ids in zip(part.column(0).to_pylist(), known.ids([t or "" for t in part.column(1).to_pylist()])):
                    ids = own_ids + end
                    for piece, first in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[first : first + 4 * capacity]
                        out.append((doc, piece, first // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return run


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document (``doc_id``, ``text``)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tables.lean_batches(_pieces(vocabulary, capacity, with_ids)), PIECES)


def reduce_by_dominance(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns that the dominance criteria fix; ``count`` (by size) keeps the rest."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for i in range(capacity, 0, -1):
            while count[i]:
                gap = capacity - i
                count[i] -= 1
                there = np.flatnonzero(count)
                first = int(there[0]) if len(there) else capacity + 1
                second = first if len(there) and count[first] > 1 else int(there[1]) if len(there) > 1 else capacity + 1
                fits = int(there[np.searchsorted(there, gap, "right") - 1]) if first <= gap else 0
                count[i] += 1
                if not fits:
                    pattern, n = (i,), int(count[i])
                elif fits == gap or first + second > gap:
                    pattern, n = (i, fits), int(count[i] // 2 if fits == i else min(count[i], count[fits]))
                else:
                    break
                for size in pattern:
                    count[size] -= n
                fixed.append((pattern, n))
                changed = True
    return fixed


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of the counted items, for groups of equal bins at once."""
    room: list[int] = []  # free sizes of open bins, sorted
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        free = capacity - sum(pattern)
        if not free:
            done.append((pattern, n))
            return
        if not open_[free]:
            insort(room, free)
        open_[free].append((pattern, n))

    for size in range(capacity, 0, -1):
        left = int(count[size])
        while left:
            at = bisect_left(room, size)
            if at < len(room):
                free = room[at]
                pattern, n = open_[free].pop()
                if not open_[free]:
                    room.pop(at)
                take = min(left, n)
                if n > take:
                    put(pattern, n - take)
                put((*pattern, size), take)
            else:
                each = min(capacity // size, left)
                take = left // each * each
                put((size,) * each, take // each)
            left -= take
    return done + [x for group in open_.values() for x in group]


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (sizes in one sequence) and how many sequences have each."""
    count = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} ids does not fit {capacity}")
        count[size] = n
    fixed = reduce_by_dominance(count, capacity)
    return fixed + best_fit(count, capacity)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By size: first rank, first sequence and offset of each run of places, ranks rising."""
    rows, used, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, n in plan:
        offset = 0
        for size in pattern:
            rows[size].append((used[size], sequence, offset))
            used[size] += n
            offset += size
        sequence += n
    return {size: tuple(np.array(c, np.int64) for c in zip(*r)) for size, r in rows.items()}


def _place(slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in (batch.schema.get_field_index("length"), batch.num_columns - 1))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                own = np.flatnonzero(length == size)
                first, base, place = slots[int(size)]
                at = np.searchsorted(first, rank[own], "right") - 1
                sequence[own] = base[at] + rank[own] - first[at]
                offset[own] = place[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and others) with ``sequence_id`` and ``offset``.

    ``pieces`` is read twice; hand in a table or a checkpoint.
    """
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # Each length is numbered by as many tasks as its pieces need; the array has ``capacity`` numbers.
    tasks = F.array(*(F.lit(1 + histogram.get(size, 0) // NUMBERED) for size in range(1, capacity + 1)))
    columns = pieces.columns
    salted = pieces.select(F.struct(*columns).alias("row"), "length", F.pmod(F.xxhash64("doc_id", "piece"), F.get(tasks, (F.col("length") - 1).cast("int"))).cast("int").alias("_salt"))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("row.doc_id", "row.piece")
    ranked = salted.withColumn("_own", F.row_number().over(own) - 1).join(offsets, ["length", "_salt"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    ready = ranked.select(*(F.col(f"row.`{c}`") for c in columns), (F.col("_before") + F.col("_own")).alias("_rank"))
    return ready.mapInArrow(tables.lean_batches(_place(_slots(packing_plan(histogram, capacity)))), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences (``sequence_id, n_ids, ids``) of packed pieces that carry ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("_parts")).select(
        "sequence_id", "n_ids", F.aggregate("_parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    pieces = tables.cut(token_pieces(tables.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids"))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
ORACLE_SQL: dict[str, str] = {}
