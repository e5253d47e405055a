"""Personal data: base patterns and bootstrapped contextual extraction.

Base entities (email, ip, card, phone) come from fixed patterns.  Beside them, tokens that
look like identifiers are taken with their lexical context: the words and marks before them
and the mark after.  Tokens that lie in base entities, and long hexadecimal strings, are the
seeds.  Spark builds the graph of contexts and (hashed) tokens over all documents and scores
it in rounds: a context is as good as the mean score of its tokens, and a token as good as
its contexts together.  Contexts with a high score and enough distinct tokens are patterns,
and every token found in one is personal data, whether or not it was a seed.

The graph holds hashes, never the values.  One context may hold a third of all tokens: its
joins are those that adaptive execution splits.  Texts are read once; found spans are joined back by a row number that
the written scan holds, never by id.

Edge cases: a null text counts as empty (no spans).  Null ids and repeated ids keep all their
rows, each with the spans of its own text.  Found spans never overlap base spans.
Very long texts are handled whole, in time linear in their length.  An empty table gives an
empty result.  Input columns other than those named are not carried by ``find``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import tables

KINDS = ("email", "ip", "card", "phone")
ROUNDS, MIN_SCORE = 3, 0.8
#: Distinct tokens that a context needs: with a mark of assignment or quotation, and without.
SUPPORT_MARKED, SUPPORT_PLAIN = 3, 25
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of digits starts where its run of digits starts: if it fails there, it fails all over the run.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{6,}")
_CONTEXT = re.compile(r"[^\W\d_]+|[=:\"']")
_HEX = re.compile(r"[0-9a-fA-F]{32,}\Z")
FOUND = "row long, doc_id long, base array<struct<kind:string,start:int,end:int>>, seen array<struct<start:int,end:int,context:string,marked:boolean,token:string,seed:boolean>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and then start; code points, end exclusive."""
    out = [("email", *span) for span in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def identifiers(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str, bool, str, bool]]:
    """Identifier-like tokens with their contexts."""
    out = []
    if not _DIGIT.search(text):
        return out
    spans, i = sorted(b[1:] for b in base), 0
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while i < len(spans) and spans[i][1] <= start:
            i += 1
        covered = i < len(spans) and spans[i][0] < end
        before = _CONTEXT.findall(text[max(0, start - 40) : start].lower())[-3:]
        after = text[end : end + 1]
        context = " ".join(before) + " _ " + (after if after in "\"',;:)]" else "")
        marked = any(x in "=:\"'" for x in before)
        if any(x not in "=:\"'" for x in before):
            out.append((start, end, context, marked, hashlib.sha256(m.group().encode()).hexdigest()[:16], bool(covered or _HEX.match(m.group()))))
    return out


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    seen_names = ("start", "end", "context", "marked", "token", "seed")
    seen_type = pa.list_(pa.struct(list(zip(seen_names, (pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.bool_())))))
    for batch in batches:
        base, seen = [], []
        for text in batch.column(2).to_pylist():
            own = base_entities(text or "")
            base.append([dict(zip(("kind", "start", "end"), x)) for x in own])
            seen.append([dict(zip(seen_names, x)) for x in identifiers(text or "", own)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, base_type), pa.array(seen, seen_type)], ["row", "doc_id", "base", "seen"])


def scan(docs: DataFrame) -> DataFrame:
    """Base entities and identifier-like tokens of each row, numbered; cut, for several uses."""
    return tables.cut(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text").mapInArrow(tables.lean_batches(_find), FOUND))


def patterns(seen: DataFrame) -> DataFrame:
    """Contexts that the scored graph accepts: ``context, score, support``."""
    edges = tables.cut(seen.groupBy("context", "token").agg(F.max("seed").cast("double").alias("seed"), F.max("marked").alias("marked")))
    tokens = edges.groupBy("token").agg(F.max("seed").alias("score"))
    enough = F.when(F.col("marked"), F.lit(SUPPORT_MARKED)).otherwise(F.lit(SUPPORT_PLAIN))
    for turn in range(ROUNDS):
        scored = tables.skewed_join(edges, tables.cut(tokens), ["token"])
        contexts = scored.groupBy("context", "marked").agg(F.avg("score").alias("confidence"), F.count("*").alias("support"))
        contexts = tables.cut(contexts.where(F.col("support") >= enough))
        if turn + 1 < ROUNDS:
            met = tables.skewed_join(edges, contexts.drop("marked"), ["context"], how="left")
            doubt = F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.99)))
            tokens = met.groupBy("token").agg(F.greatest(F.max("seed"), 1 - F.exp(F.sum(doubt))).alias("score"))
    return contexts.where(F.col("confidence") >= MIN_SCORE).select("context", F.col("confidence").alias("score"), "support")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` spans and ``found`` spans (arrays of kind, start, end), a row for each of ``docs``."""
    scanned = scan(docs)
    seen = scanned.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    hits = tables.skewed_join(seen, patterns(seen).select("context"), ["context"])
    extra = hits.groupBy("row").agg(F.collect_list(F.struct(F.lit("found").alias("kind"), "start", "end")).alias("_hits"))
    joined = scanned.join(extra, "row", "left")
    apart = F.filter(F.coalesce("_hits", F.array()), lambda h: ~F.exists("base", lambda b: (b["start"] < h["end"]) & (h["start"] < b["end"])))
    return joined.select("doc_id", "base", F.sort_array(apart).alias("found"))


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each span of ``found`` replaced by its kind in brackets; ``key`` must be unique and not null."""
    own, extra = tables.fresh(docs, "_key"), tables.fresh(docs, "_spans")
    spans = found.select(F.col("doc_id").alias(own), F.concat("base", "found").alias(extra))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = [masked(t, s or []) for t, s in zip(batch.column(at).to_pylist(), batch.column(extra).to_pylist())]
            yield batch.set_column(at, text, pa.array(new, pa.string())).drop_columns([extra])

    joined = docs.join(spans, docs[key] == spans[own], "left").drop(own)
    return joined.mapInArrow(tables.lean_batches(run), docs.schema)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data of each row replaced, whatever its ``doc_id``."""
    row = tables.fresh(docs, "_row")
    numbered = tables.cut(docs.withColumn(row, F.monotonically_increasing_id()))
    return redact(numbered, find(numbered.select(F.col(row).alias("doc_id"), "text")), row).drop(row)


def masked(text: str | None, spans: list[dict]) -> str | None:
    """The text with spans replaced; of overlapping spans the union is replaced by the first's kind."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and all spans of every document."""
    found = find(tables.documents(spark, sf_dir))

    def told(c: str):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(k: str):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(told("base"), 256).alias("base_sha256"), F.concat_ws(",", *(F.when(F.size(c) > 0, told(c)) for c in ("base", "found"))).alias("spans"))


QUERIES = {"op7_personal_data": op7_personal_data}
ORACLE_SQL: dict[str, str] = {}
