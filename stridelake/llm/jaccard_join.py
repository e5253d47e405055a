"""Exact n-gram Jaccard join by universe partitioning.

Sets of five-word shingles that link differ in a bounded number of shingles: at a threshold
of 3/4, |x| + |y| - 2|x & y| <= (|x| + |y|) / 7.  Sizes are banded by a ratio of 4/3, so a
set meets its partners in its own band and the next.  For each band the universe of
shingles is hashed into more segments than two linked sets of the band can differ in, so
that by the pigeonhole principle some segment is equal.  Allocation is by cost: every set
indexes all its segments, but searches only through as many as the principle needs, the
rarest ones (by their rarest shingle, as counted in its batch; empty ones last).  Segments that hold just a common
passage are thereby indexed but hardly ever searched.  Bands of small sets use half as many
segments with their one-deletion neighbourhoods instead.

Pairs are first held against parity sketches: a bit for each of four times as many places as the
set has shingles (eight times at most), flipped by every shingle that falls there.  Two sketches differ in at most
as many bits as the sets differ in shingles, so a pair that differs in too many bits is no
link for sure, and its texts need not be read.

Keys travel in batches to their buckets, each with its document and a mark if it is
searched.  Candidates of a key are the pairs of a searching and an indexed set of fitting
sizes; of a large group, first the pairs with its first document.  Candidates are verified
exactly on the texts in two passes.  The first takes each document's most promising partner
only; the components that this gives answer for most pairs of large groups of near copies,
since a pair inside a component needs no check.  The second verifies every pair of
candidates between different components.  No pair of candidates is left out otherwise.

Documents with equal sets are one node throughout; memberships are joined back at the end.

Edge cases: a null or empty text, or one without words, has an empty set and links with
nothing.  A text of fewer than five words has its word sequence as the one shingle.  Rows
with a null id are left out.  Repeated rows of an id give repeated result rows.  Very long texts are handled
whole.  An empty table gives an empty result.  Input columns other than the two named are
not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import components, tables, textbytes
from stridelake.llm.textbytes import U64

WIDTH = 5
#: Documents of one key up to which all its pairs are candidates at once.
SMALL_GROUP = 16
#: Pairs whose texts a task holds as arrays at the same time.
VERIFIED_AT_ONCE = 200
#: Pairs of a cell whose texts, or whose sketches, meet in a task.
VERIFIED_IN_CELL, SKETCHED_IN_CELL = 500, 20_000
#: Members of a key that a task compares with each other; a larger key is cut into cells of so many on either side.
CELL = 4096
BATCH_BYTES, BUCKET_BYTES = 4 << 20, 6 << 20
#: Ids up to which the documents to verify are picked by a broadcast (8 bytes each); beyond, by a shuffle.
BROADCAST_IDS = 500_000
KEYS = "bucket int, n int, owners binary, keys binary"
PAIRS = "kind int, a long, b long, key long"


def bands(largest: int) -> np.ndarray:
    """Least sizes of the bands; a size's partners are at most one band away."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * 4 // 3)))
    return np.array([*out, max(out[-1] + 1, -(-out[-1] * 4 // 3))], np.int64)


def text_shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle), sorted."""
    _, _, row, hashes = textbytes.word_hashes(data, offsets)
    return textbytes.distinct_pairs(*textbytes.shingles(row, hashes, len(offsets) - 1, width))


def parity_sketches(row: np.ndarray, name: np.ndarray, size: np.ndarray) -> list[bytes]:
    """A sketch for each row: 128 bits times a power of two, at least four times the set's size."""
    bits = 128 << np.ceil(np.log2(np.maximum(size, 32) / 32)).astype(np.int64)
    base = np.concatenate(([0], np.cumsum(bits)))
    place = (textbytes.mix(name + U64(3)) & (bits[row] - 1).astype(U64)).astype(np.int64)
    odd = np.bincount(base[row] + place, minlength=base[-1]) & 1
    whole = np.packbits(odd.astype(np.uint8)).tobytes()
    return [whole[a >> 3 : b >> 3] for a, b in zip(base, base[1:])]


def fold(sketch: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches (bytes) folded to ``width`` bytes; parity makes the halves add up."""
    while sketch.shape[1] > width:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def too_far(left: list[bytes], right: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Pairs whose sketches differ in more bits than linked sets of these sizes (summed) can."""
    out = np.zeros(len(left), bool)
    lw, rw = (np.array([len(x) for x in side]) for side in (left, right))
    for a, b in {*zip(lw.tolist(), rw.tolist())}:
        at = np.flatnonzero((lw == a) & (rw == b))
        x = np.frombuffer(b"".join(left[i] for i in at), np.uint8).reshape(-1, a)
        y = np.frombuffer(b"".join(right[i] for i in at), np.uint8).reshape(-1, b)
        narrow = min(a, b)
        out[at] = np.bitwise_count(fold(x, narrow) ^ fold(y, narrow)).sum(1, dtype=np.int64) * 7 > sizes[at]
    return out


def _combined(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each pair and each row of its two documents: the pair, and the two rows; ``doc`` is sorted."""
    la, ha, lb, hb = (np.searchsorted(doc, x, side) for x in (a, b) for side in ("left", "right"))
    na, nb = ha - la, hb - lb
    pair = np.repeat(np.arange(len(a)), na * nb)
    k = textbytes.ragged(np.zeros(len(a), np.int64), na * nb)
    return pair, la[pair] + k // np.maximum(nb[pair], 1), lb[pair] + k % np.maximum(nb[pair], 1)


def _plausible(pairs: pa.Table, held: pa.Table) -> pa.Table:
    """Pairs (a, b, w) that sizes and sketches of their documents do not rule out."""
    held = held.sort_by("doc_id")
    doc, size, sketch = held.column("doc_id").to_numpy(), held.column("n_shingles").to_numpy(), held.column("sketch").to_pylist()
    pair, x, y = _combined(doc, pairs.column("a").to_numpy(), pairs.column("b").to_numpy())
    near = ~too_far([sketch[i] for i in x], [sketch[i] for i in y], size[x] + size[y]) if len(pair) else np.zeros(0, bool)
    keep = np.zeros(len(pairs), bool)
    keep[pair[near]] = True
    return pairs.select(["a", "b", "w"]).filter(pa.array(keep))


def meet(pairs: DataFrame, docs: DataFrame, kernel, schema: str, a_cell: int) -> DataFrame:
    """``kernel(pairs, documents)`` over cells of about ``a_cell`` pairs and the rows of ``docs`` (by ``doc_id``) that they name.

    Pairs are dealt by both of their ids, so documents that have many partners among each
    other travel to a few cells, not to every pair.  A cell that is larger nevertheless is
    dealt again by its pairs.  ``pairs`` is read three times; hand in a checkpoint.
    """
    side = max(1, math.isqrt(pairs.count() // a_cell))
    dealt = pairs.withColumn("cell", tables.block_of(F.col("a"), side).cast("long") * side + tables.block_of(F.col("b"), side))
    large = tables.cut(dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 4 * a_cell))
    part = F.coalesce(F.pmod(F.xxhash64("a", "b"), F.ceil(F.col("_n") / a_cell)), F.lit(0)).cast("int")
    dealt = tables.skewed_join(dealt, large, ["cell"], how="left").withColumn("part", part).drop("_n")
    named = dealt.select(F.col("cell").alias("cell"), F.col("part").alias("part"), F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    held = tables.skewed_join(named, docs, ["doc_id"])
    return dealt.groupBy("cell", "part").cogroup(held.groupBy("cell", "part")).applyInArrow(tables.lean(kernel), schema)


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textbytes.buffer_of(batch.column(1))
            for i, j in textbytes.pieces(offsets, BATCH_BYTES):
                row, name = text_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                n = j - i
                x, y = np.zeros(n, U64), np.zeros(n, U64)
                if len(row):
                    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                    with np.errstate(over="ignore"):
                        x[row[heads]] = np.add.reduceat(textbytes.mix(name + U64(1)), heads)
                        y[row[heads]] = np.add.reduceat(textbytes.mix(name + U64(2)), heads)
                size = np.bincount(row, minlength=n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(size), pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.array(parity_sketches(row, name, size), pa.binary())], ["doc_id", "n_shingles", "x", "y", "sketch"])

    return run


def set_digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles``, a 128-bit digest (``x``, ``y``) and the parity sketch of the shingle set."""
    return docs.mapInArrow(tables.lean_batches(_describe(width)), "doc_id long, n_shingles long, x long, y long, sketch binary")


def signatures(row: np.ndarray, name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, searched) of the sets given as distinct, sorted (row, shingle)."""
    size = np.bincount(row, minlength=n)
    edges = bands(int(size.max(initial=1)))
    band = np.searchsorted(edges, size, "right") - 1
    rows, keys, searched = [], [], []
    _, which, times = np.unique(name, return_inverse=True, return_counts=True)
    common = times[which]  # documents of the batch that have the shingle
    for lower in (0, 1):  # the own band's group, and the group of the band below
        group = band - lower
        use = (size > 0) & (group >= 0)
        top = edges[np.maximum(group, 0) + 1] - 1  # the largest size of the group's lower band
        most = (top + top * 4 // 3) // 7
        least_partner = np.where(lower == 0, np.minimum(size * 4 // 3, edges[np.maximum(group, 0) + 2] - 1), top)
        differ = (size + least_partner) // 7  # what a linked partner in this group can differ in
        few = most <= 3
        parts = np.where(few, most // 2 + 1, (top * 42 + 99) // 100 + 5)
        at = np.flatnonzero(use[row])
        r, h = row[at], name[at]
        with np.errstate(over="ignore"):
            spread = textbytes.mix(h ^ (group[r].astype(U64) * U64(0x9E3779B97F4A7C15)))
            value = textbytes.mix(h + U64(0x51ED270B))
        segment = ((spread >> U64(33)).astype(np.int64) * parts[r]) >> 31
        base = np.concatenate(([0], np.cumsum(np.where(use, parts, 0))))
        cell = base[r] + segment
        owner = np.repeat(np.arange(n), np.where(use, parts, 0))
        total = np.zeros(base[-1], U64)
        with np.errstate(over="ignore"):
            np.add.at(total, cell, value)

        def name_of(content: np.ndarray, own: np.ndarray, place: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return textbytes.mix(content * U64(0xC2B2AE3D27D4EB4F) + group[own].astype(U64) * U64(1_000_003) + place.astype(U64))  # noqa: B023

        place = np.arange(base[-1]) - base[owner]
        full = name_of(total, owner, place)
        small = few[owner]
        # One-deletion neighbourhoods of small bands: both sides index and search everything.
        mine = np.flatnonzero(few[r])
        with np.errstate(over="ignore"):
            less = name_of(total[cell[mine]] - value[mine], r[mine], segment[mine])
        rows += [owner[small], r[mine]]
        keys += [full[small], less]
        searched += [np.ones(int(small.sum()), bool), np.ones(len(mine), bool)]
        # Large bands: the rarest of the equal segments, as many as the pigeonhole principle needs.
        big = np.flatnonzero(~small)
        rarest = np.full(base[-1], len(row) + 1)
        np.minimum.at(rarest, cell, common[at])
        order = np.lexsort((full[big], rarest[big], owner[big]))
        big = big[order]
        first = np.searchsorted(owner[big], owner[big], "left")
        search = np.arange(len(big)) - first <= differ[owner[big]]
        rows.append(owner[big])
        keys.append(full[big])
        searched.append(search)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(searched)


def _index(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = textbytes.buffer_of(batch.column(1))
            for i, j in textbytes.pieces(offsets, BATCH_BYTES):
                row, name = text_shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                row, name = _distinct_sets(row, name, ids[i:j])
                if not len(row):
                    continue
                size = np.bincount(row, minlength=j - i)
                owner, key, searched = signatures(row, name, j - i)
                bucket = (key % U64(buckets)).astype(np.int64)
                order = np.lexsort((owner, bucket))
                owner, key, searched, bucket = owner[order], key[order], searched[order], bucket[order]
                cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
                rows = []
                for a, b in zip(cuts, cuts[1:]):
                    own, place = np.unique(owner[a:b], return_inverse=True)
                    code = np.diff(place, prepend=0) * 2 + searched[a:b]
                    owners = textbytes.planes(np.diff(ids[i:j][own], prepend=0), "<i8") + textbytes.planes(size[own], "<i4") + textbytes.planes(code, "<u2")
                    rows.append((int(bucket[a]), len(own), press(owners), (key[a:b] // U64(buckets) & U64(0xFFFFFFFF)).astype("<u4").tobytes()))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], [c.split()[0] for c in KEYS.split(", ")])

    return run


def _distinct_sets(row: np.ndarray, name: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal sets in a batch only the one with the least id."""
    n = len(ids)
    digest = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        np.add.at(digest, row, textbytes.mix(name + U64(1)))
    order = np.lexsort((ids, digest))
    keep = np.zeros(n, bool)
    keep[order] = np.concatenate(([True], digest[order][1:] != digest[order][:-1])) if n else keep
    stay = keep[row]
    return row[stay], name[stay]


def _candidates(table: pa.Table) -> pa.Table:
    """Pairs of the small groups (kind 0), pairs with the first of large groups (kind 1), members of large groups (2 indexed, 3 searched)."""
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    bucket = table.column("bucket")[0].as_py()
    doc, size, key, searched = [], [], [], []
    for n, owners, keys in zip(*(table.column(c) for c in ("n", "owners", "keys"))):
        n, whole = n.as_py(), np.frombuffer(open_(owners.as_py()), np.uint8)
        ids, sizes, code = textbytes.of_planes(whole[: 8 * n], "<i8"), textbytes.of_planes(whole[8 * n : 12 * n], "<i4"), textbytes.of_planes(whole[12 * n :], "<u2").astype(np.int64)
        place = np.cumsum(code >> 1)
        doc.append(np.cumsum(ids)[place])
        size.append(sizes[place])
        searched.append(code & 1 == 1)
        key.append(np.frombuffer(keys.as_py(), "<u4"))
    doc, size, key, searched = map(np.concatenate, (doc, size, key, searched))
    # One entry a key and document; searched if any is.
    order = np.lexsort((~searched, doc, key))
    doc, size, key, searched = doc[order], size[order], key[order], searched[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
    doc, size, key, searched = doc[new], size[new].astype(np.int64), key[new], searched[new]
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    counts = np.diff(np.concatenate((heads, [len(key)])))
    wanted = (counts > 1) & (np.add.reduceat(searched, heads) > 0)
    out = []
    for n in np.unique(counts[wanted & (counts <= SMALL_GROUP)]):
        at = heads[wanted & (counts == n)]
        i, j = np.triu_indices(n, 1)
        a, b = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
        fit = (searched[a] | searched[b]) & (np.minimum(size[a], size[b]) * 4 >= np.maximum(size[a], size[b]) * 3)
        out.append((np.zeros(int(fit.sum()), np.int64), doc[a[fit]], doc[b[fit]], np.zeros(int(fit.sum()), np.int64)))
    large = wanted & (counts > SMALL_GROUP)
    member = textbytes.ragged(heads[large], counts[large])
    first = np.repeat(heads[large], counts[large])
    fit = (member != first) & (np.minimum(size[member], size[first]) * 4 >= np.maximum(size[member], size[first]) * 3)
    out.append((np.ones(int(fit.sum()), np.int64), doc[first[fit]], doc[member[fit]], np.zeros(int(fit.sum()), np.int64)))
    names = (np.int64(bucket) << 32) + key[member].astype(np.int64)
    out.append((2 + searched[member].astype(np.int64), doc[member], size[member], names))
    kind, a, b, key = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*out))
    # A pair's weight is how many keys it has here.
    pair = kind < 2
    order = np.lexsort((kind[pair], b[pair], a[pair]))
    pa_, pb, pk = a[pair][order], b[pair][order], kind[pair][order]
    new = np.flatnonzero(np.concatenate(([True], (pa_[1:] != pa_[:-1]) | (pb[1:] != pb[:-1])))) if len(pa_) else np.zeros(0, np.int64)
    weight = np.diff(np.concatenate((new, [len(pa_)])))
    columns = (np.concatenate((pk[new], kind[~pair])), np.concatenate((pa_[new], a[~pair])), np.concatenate((pb[new], b[~pair])), np.concatenate((weight, key[~pair])))
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *(pa.int64(),) * 3))], names=["kind", "a", "b", "key"])


def _cross(table: pa.Table) -> pa.Table:
    """Pairs of a searching (``left``) and an indexed (``right``) member of a cell that lie in different components.

    Pairs that the sketches rule out are left out.
    """
    doc, size, comp, searched, left, right = (table.column(c).to_numpy() for c in ("doc", "size", "component", "searched", "left", "right"))
    out = []
    if len(np.unique(comp)) > 1:
        order = np.argsort(size, kind="stable")
        doc, size, comp, searched, left, right = (x[order] for x in (doc, size, comp, searched, left, right))
        raw = table.column("sketch").to_pylist()
        raw = [raw[i] for i in order]
        widths = np.array([len(x) for x in raw])
        classes = {int(w): np.flatnonzero(widths == w) for w in np.unique(widths)}  # runs, since sizes rise
        matrix = {w: np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(-1, w) for w, at in classes.items()}
        for i in np.flatnonzero(left):
            lo, hi = np.searchsorted(size * 4, size[i] * 3, "left"), np.searchsorted(size * 3, size[i] * 4, "right")
            for w, at in classes.items():
                other = at[(at >= lo) & (at < hi)]
                other = other[right[other] & (comp[other] != comp[i]) & (~searched[other] | (doc[other] > doc[i]))]
                if len(other):
                    narrow = min(w, int(widths[i]))
                    apart = np.bitwise_count(fold(matrix[w][other - at[0]], narrow) ^ fold(np.frombuffer(raw[i], np.uint8)[None], narrow)).sum(1, dtype=np.int64)
                    other = other[apart * 7 <= size[other] + size[i]]
                    out.append(np.stack((np.minimum(doc[other], doc[i]), np.maximum(doc[other], doc[i])), 1))
    pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
    return pa.table([pa.array(pairs[:, 0].astype(np.int64)), pa.array(pairs[:, 1].astype(np.int64))], names=["a", "b"])


def _verify(width: int, percent: int):
    def run(pairs: pa.Table, held: pa.Table) -> pa.Table:
        held, pairs = held.sort_by("doc_id"), pairs.sort_by([("a", "ascending"), ("b", "ascending")])
        doc, texts = held.column("doc_id").to_numpy(), held.column("text").combine_chunks()
        linked = np.zeros(len(pairs), bool)
        for begin in range(0, len(pairs), VERIFIED_AT_ONCE):
            some = pairs.slice(begin, VERIFIED_AT_ONCE)
            pair, x, y = _combined(doc, some.column("a").to_numpy(), some.column("b").to_numpy())
            rows, which = np.unique(np.concatenate((x, y)), return_inverse=True)
            data, offsets = textbytes.buffer_of(texts.take(pa.array(rows)))
            row, name = text_shingles(data, offsets, width)
            at = np.searchsorted(row, np.arange(len(rows) + 1))
            size = np.diff(at)
            i, j = which[: len(x)], which[len(x) :]
            both = np.array([len(np.intersect1d(name[at[p] : at[p + 1]], name[at[q] : at[q + 1]], assume_unique=True)) for p, q in zip(i, j)], np.int64)
            good = both * 100 >= (size[i] + size[j] - both) * percent
            linked[begin + pair[good]] = True
        return pairs.select(["a", "b"]).filter(pa.array(linked))

    return run


def verify(pairs: DataFrame, docs: DataFrame, percent: int, width: int = WIDTH) -> DataFrame:
    """Links among ``pairs`` (``a``, ``b``): those whose sets are similar enough, cut."""
    pairs = tables.cut(pairs.select("a", "b"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    few = pairs.count() * 2 <= BROADCAST_IDS  # at most twice as many ids as pairs
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    return tables.cut(meet(pairs, texts, _verify(width, percent), "a long, b long", VERIFIED_IN_CELL))


def similar(docs: DataFrame, percent: int = 75, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, set_id, component_id`` of each document (``doc_id``, ``text``).

    ``set_id`` is the least document with the same shingle set.  ``percent`` may not be
    under 75, which the bands and segments are made for.
    """
    if not 75 <= percent <= 100:
        raise ValueError("percent must be from 75 to 100")
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    sets = tables.cut(set_digests(docs, width))
    digest = ["x", "y", "n_shingles"]
    copies = tables.cut(sets.where("n_shingles > 0").groupBy(*digest).agg(F.min("doc_id").alias("set_id"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    members = tables.cut(tables.skewed_join(sets, copies, digest, how="left").select("doc_id", "n_shingles", F.coalesce("set_id", "doc_id").alias("set_id")))
    copy_of = members.where("doc_id != set_id").select("doc_id", "set_id").distinct()

    buckets = tables.block_count(docs, "text", BUCKET_BYTES)
    keys = docs.mapInArrow(tables.lean_batches(_index(width, buckets)), KEYS)
    found = tables.cut(keys.groupBy("bucket").applyInArrow(tables.lean(_candidates), PAIRS))

    def node(df: DataFrame, column: str) -> DataFrame:
        met = df.join(copy_of.withColumnRenamed("doc_id", column), column, "left")
        return met.withColumn(column, F.coalesce("set_id", column)).drop("set_id")

    pairs = node(node(found.where("kind < 2").groupBy("a", "b").agg(F.sum("key").alias("w")), "a"), "b")
    pairs = pairs.where("a != b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w"))
    sketches = sets.select("doc_id", "n_shingles", "sketch")
    pairs = tables.cut(meet(tables.cut(pairs), sketches, _plausible, "a long, b long, w long", SKETCHED_IN_CELL))
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("w", -F.col("a"))).alias("a")).select("a", "b")
    first = verify(best, docs, percent, width)
    labels = components.components(first)

    def component(df: DataFrame, column: str, out: str) -> DataFrame:
        named = labels.select(F.col("node").alias(column), F.col("component").alias(out))
        return tables.skewed_join(df, named, [column], how="left").withColumn(out, F.coalesce(out, column))

    open_pairs = component(component(pairs.select("a", "b"), "a", "ca"), "b", "cb").where("ca != cb").select("a", "b")
    groups = node(found.where("kind >= 2").select(F.col("a").alias("doc"), F.col("b").alias("size"), "key", (F.col("kind") == 3).alias("searched")), "doc")
    groups = groups.groupBy("key", "doc", "size").agg(F.max("searched").alias("searched"))
    labelled = component(groups, "doc", "component").select("key", "doc", "size", "component", "searched")
    cells = lambda n: F.greatest(F.lit(1), F.ceil(n / CELL)).cast("int")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"), cells(F.count("*")).alias("_j"), cells(F.count_if("searched")).alias("_i"))
    mixed = tables.cut(mixed.where("_a != _b").select("key", "_i", "_j"))
    cell = F.expr("""explode(CASE WHEN _j = 1 THEN array(struct(0 AS i, 0 AS j, searched AS left, true AS right)) ELSE concat(
        transform(sequence(0, _i - 1), x -> struct(x AS i, cast(pmod(xxhash64(doc), _j) AS int) AS j, false AS left, true AS right)),
        transform(IF(searched, sequence(0, _j - 1), array()), x -> struct(cast(pmod(xxhash64(doc, 1), _i) AS int) AS i, x AS j, true AS left, false AS right))) END)""")
    kept = tables.skewed_join(labelled, mixed, ["key"]).select("key", "doc", "size", "component", "searched", cell.alias("cell")).select("key", "cell.*", "doc", "size", "component", "searched")
    kept = kept.join(sketches.select(F.col("doc_id").alias("doc"), "sketch").dropDuplicates(["doc"]), "doc")
    cross = kept.groupBy("key", "i", "j").applyInArrow(tables.lean(_cross), "a long, b long")
    rest = open_pairs.unionByName(cross).distinct().join(best, ["a", "b"], "left_anti")
    second = verify(rest, docs, percent, width)
    final = components.components(first.unionByName(second))
    named = final.select(F.col("node").alias("set_id"), F.col("component").alias("component_id"))
    return tables.skewed_join(members, named, ["set_id"], how="left").withColumn("component_id", F.coalesce("component_id", "set_id")).select("doc_id", "n_shingles", "set_id", "component_id")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return similar(tables.documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op3_jaccard_join": op3_jaccard_join}
ORACLE_SQL: dict[str, str] = {}
