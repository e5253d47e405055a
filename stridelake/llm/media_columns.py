"""Interleaved document sequences: text and media references in page order.

``parse_sequences`` turns each HTML page into rows (page, position, kind, text, digest,
caption): runs of text and references to media, in the order of the page, each reference
with the caption of its figure (or its alternative text).  ``media_store`` writes payloads
losslessly as 8-bit greyscale PNG files of 192 samples a row to a media column of a table in the
shared folder, reads the stored column back and computes features on what it read.  ``resolve`` joins references to the store by
digest.  A digest that a third of all references name is no hot group: references are
salted, and each (digest, salt) meets the store once.

Edge cases: a null page or payload counts as empty (a page without rows; a payload of 192
spaces).  References without a stored payload keep null media columns.  Repeated payloads
have one row in the store's result.  Positions count from 0 within a page, without gaps.  Input
columns other than those named are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import htmltokens, tables

ROW, SALTS, LEVEL = 192, 64, 6
SEQUENCE = "key long, position int, kind string, text string, digest string, caption string"
FEATURES = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_BLOCKS = {"p", "div", "article", "section", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "figure", "figcaption", "table", "tr", "td", "th", "blockquote", "pre", "header", "footer", "nav", "aside", "main", "body", "html", "hr", "dl", "dt", "dd", "form"}
_MEDIA = {"img", "video", "audio", "source", "embed", "object"}
_HIDDEN = {"script", "style", "noscript", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}


def page_sequence(html: str) -> list[tuple[str, str | None, str | None, str | None]]:
    """(kind, text, reference, caption) in page order."""
    out: list[list] = []
    buffer: list[str] = []
    figures: list[tuple[int, list[str]]] = []
    captions, hidden = 0, 0

    def flush() -> None:
        said = " ".join("".join(buffer).split())
        buffer.clear()
        if said:
            out.append(["text", said, None, None])

    for kind, name, rest in htmltokens.tokens(html):
        if kind == "text":
            if not hidden:
                (figures[-1][1] if captions and figures else buffer).append(rest)
            continue
        if name in _HIDDEN:
            hidden += 1 if kind == "open" else -(hidden > 0)
            continue
        if name in _BLOCKS:
            flush()
        if name in _MEDIA and kind == "open":
            a = htmltokens.attributes(rest)
            if a.get("src") or a.get("data"):
                flush()
                out.append(["media", None, a.get("src") or a.get("data"), " ".join(a.get("alt", "").split()) or None])
        elif name == "figure":
            if kind == "open":
                figures.append((len(out), []))
            elif figures:
                first, said = figures.pop()
                if caption := " ".join("".join(said).split()):
                    for row in out[first:]:
                        if row[0] == "media":
                            row[3] = caption
        elif name == "figcaption":
            captions += 1 if kind == "open" else -(captions > 0)
    flush()
    return [tuple(r) for r in out]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, i, *row) for key, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, row in enumerate(page_sequence(html or ""))]
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "position", "kind", "text", "digest", "caption"])


def parse_sequences(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Ordered text and media references; a reference ``sha256:<hex>`` gives its digest."""
    parsed = pages.select(F.col(key).cast("long"), html).mapInArrow(tables.lean_batches(_parse), SEQUENCE)
    return parsed.withColumn("digest", F.regexp_extract("digest", r"^sha256:([0-9a-f]{64})$", 1)).withColumn("digest", F.when(F.col("digest") != "", F.col("digest")))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """A greyscale PNG file of a payload whose length is a positive multiple of ROW."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(rows), ROW + 1), np.uint8)
    lines[:, 1:] = rows
    return _SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> np.ndarray:
    """Samples (rows x width) of a file that :func:`to_png` wrote; its checksums are verified."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, data, shape = 8, b"", (0, 0)
    while at < len(media):
        (n,) = struct.unpack(">I", media[at : at + 4])
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a PNG chunk is damaged")
        if kind == b"IHDR":
            width, height = struct.unpack(">II", body[:8])
            shape = (height, width)
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(shape[0], shape[1] + 1)
    if lines[:, 0].any():
        raise ValueError("unexpected row filter")
    return lines[:, 1:]


def feature_of(samples: np.ndarray) -> str:
    """64 bits of an average hash over equal stretches, mean, deviation and entropy of the samples."""
    flat = samples.reshape(-1)
    edges = np.linspace(0, flat.size, 65).astype(int)
    means = np.add.reduceat(flat, edges[:-1], dtype=np.int64) / np.maximum(np.diff(edges), 1)
    bits = np.packbits(means > np.median(means)).tobytes().hex()
    share = np.bincount(flat, minlength=256) / flat.size
    share = share[share > 0]
    return f"{bits}:{flat.mean():.4f}:{flat.std():.4f}:{-(share * np.log2(share)).sum() + 0.0:.4f}"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            digests, media = [], []
            for data in batch.column(0).slice(at, 500).to_pylist():
                data = data or b""
                payload = data + b" " * (-len(data) % ROW or (0 if data else ROW))
                digests.append(hashlib.sha256(payload).hexdigest())
                media.append(to_png(payload))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(media, pa.binary())], ["digest", "media"])


def _read_back(with_media: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FEATURES.split(", ")] + ["media"] * with_media
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * with_media
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for digest, media in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    samples = from_png(media)
                    back = samples.tobytes()
                    row = (digest, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(samples))
                    rows.append((*row, media) if with_media else row)
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def media_store(payloads: DataFrame, payload: str, with_media: bool = True) -> DataFrame:
    """One row a distinct padded payload: digest, features of its samples and, if asked for, the stored file ``media``.

    The files are written where they are made, as a column of a table in the shared folder;
    features are computed on what is read back from there.  Only digests and features (and
    the files that are asked for) move to meet their equals.
    """
    made = payloads.select(F.col(payload).cast("binary")).mapInArrow(tables.lean_batches(_encode), "digest string, media binary")
    read = tables.written(made).mapInArrow(tables.lean_batches(_read_back(with_media)), FEATURES + ", media binary" * with_media)
    return read.groupBy("digest").agg(*(F.first(c).alias(c) for c in read.columns if c != "digest"))


def digest_of(text: Column) -> Column:
    """Digest of a text's payload: its bytes, padded with spaces to a positive multiple of ROW."""
    n = F.octet_length(text)
    pad = F.when(n == 0, F.lit(ROW)).otherwise(F.pmod(-n, F.lit(ROW)))
    return F.sha2(F.concat(text, F.repeat(F.lit(" "), pad)), 256)


def resolve(references: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """``references`` (with ``digest``) joined to the store; unknown digests get nulls."""
    salted = references.withColumn("_salt", tables.block_of(F.col(key), SALTS))
    wanted = salted.select("digest", "_salt").where("digest IS NOT NULL").distinct().join(store, "digest")
    return salted.join(wanted, ["digest", "_salt"], "left").drop("_salt")


def document_pages(docs: DataFrame) -> DataFrame:
    """Each document as an interleaved page: text runs, its payload in a captioned figure, and the payload again at the end."""
    text = F.coalesce("text", F.lit(""))
    html = F.format_string(
        '<article><p>Payload of %d bytes follows.</p><figure><img src="sha256:%s" alt=""><figcaption>%d</figcaption></figure><p>It ends here.</p><img src="sha256:%s" alt="again"></article>',
        F.octet_length(text), digest_of(text), F.octet_length(text), digest_of(text),
    )
    return docs.select("doc_id", html.alias("html"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page with its text as media: stored, read back and resolved; the captioned reference of each page."""
    docs = tables.documents(spark, sf_dir)
    references = parse_sequences(document_pages(docs), "doc_id", "html").where("kind = 'media' AND position = 1")
    found = resolve(references, media_store(docs, "text", with_media=False), "key")
    return found.select(F.col("key").alias("doc_id"), F.col("caption").cast("long").alias("n_bytes"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position")


QUERIES = {"op6_media_columns": op6_media_columns}
ORACLE_SQL: dict[str, str] = {}
