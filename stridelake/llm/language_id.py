"""Language identification of mixed-language text by script ranges and Viterbi.

Training counts hashed byte trigrams (with word edges) and letters by script for each
language, over all labelled documents that it is given; the model is a table of at most
``BUCKETS`` scores a language, a size that does not depend on the corpus.

Prediction scores every word for every language.  The script of a word (by the ranges of
its lead bytes) narrows the languages to those that use it.  Viterbi over the words, with a
penalty for switching, labels spans; it runs over all texts of a batch at once, one step a
word, longest texts first.

The predicted language is the one with most bytes in its spans, the score their share; ties
go to the first language in alphabetical order.  A text of letters that tell nothing (of a
script that no language uses, say) goes there as well, with an even share as its score.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and no spans; so is
every text when nothing was learned.  Very long texts take time linear in their length.
Repeated rows are judged alike; an empty table gives an empty result.  Input columns other
than those named are not carried, and never serve as inputs of a prediction.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import tables, textbytes

BUCKETS, PIECE = 1 << 15, 8 << 20
#: Cost (in nats) of a change of language between two words.
SWITCH = 12.0
SMOOTHING = 0.5
#: A language uses a script if it has at least this share of the language's letters.
SCRIPT_SHARE = 0.001
#: Scripts by the first byte of a UTF-8 character.
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul")
_SCRIPT = np.full(256, -1, np.int8)
for _code, _ranges in enumerate(([(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)], [(0xCD, 0xCF)], [(0xD0, 0xD4)], [(0xD6, 0xD7)], [(0xD8, 0xDB)], [(0xE0, 0xE0)], [(0xE3, 0xE3)], [(0xE4, 0xE9)], [(0xEA, 0xED)])):
    for _a, _b in _ranges:
        _SCRIPT[_a : _b + 1] = _code
PREDICTED = "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


@dataclass
class Model:
    """Languages in order, trigram scores (language x bucket) and allowed scripts (script x language)."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray


def _codes(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each byte; outside of the buffer there are spaces."""
    flat = np.where(textbytes.IS_SPACE[data], np.uint8(32), textbytes.LOWER[data]).astype(np.uint32)
    wide = np.concatenate(([np.uint32(32)], flat, [np.uint32(32)]))
    x = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int32)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space after each, so that no trigram crosses two of them."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    return out, offsets + np.arange(n + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + len(SCRIPTS), np.int64))
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        data, offsets = textbytes.buffer_of(batch.column(0))
        for i, j in textbytes.pieces(offsets, PIECE):
            part, off = _spaced(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            codes, script = _codes(part), _SCRIPT[part]
            names, which = np.unique(langs[i:j].astype(str), return_inverse=True)
            row = np.repeat(which, np.diff(off))
            inside = ~textbytes.IS_SPACE[part]
            grams = np.bincount(row[inside].astype(np.int64) * BUCKETS + codes[inside], minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            letters = script >= 0
            by_script = np.bincount(row[letters].astype(np.int64) * len(SCRIPTS) + script[letters], minlength=len(names) * len(SCRIPTS)).reshape(len(names), len(SCRIPTS))
            for k, name in enumerate(names):
                total[str(name)] += np.concatenate((grams[k], by_script[k]))
    for name, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["lang", "bucket", "n"])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model of all rows that have a language; at most BUCKETS counts a language reach the driver."""
    counts = labelled.where(F.col(lang).isNotNull()).select(text, lang).mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    table[np.searchsorted(languages, found["lang"]), found["bucket"]] = found["n"]
    grams, letters = table[:, :BUCKETS], table[:, BUCKETS:]
    scores = np.log((grams + SMOOTHING) / (grams.sum(1, keepdims=True) + SMOOTHING * BUCKETS))
    share = letters / np.maximum(letters.sum(1, keepdims=True), 1)
    return Model(languages, scores.astype(np.float32), (share >= SCRIPT_SHARE).T)


def word_scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, rows and (word x language) scores of the words of spaced texts."""
    start, end, row = textbytes.words(data, offsets)
    out = np.zeros((len(start), len(model.languages)), np.float32)
    if len(start):
        codes = _codes(data)
        edges = np.empty(2 * len(start), np.int64)
        edges[::2], edges[1::2] = start, end
        edges = edges[:-1] if edges[-1] >= len(data) else edges
        for k in range(len(model.languages)):
            out[:, k] = np.add.reduceat(model.scores[k][codes], edges)[::2]
        script = np.maximum.reduceat(_SCRIPT[data], edges)[::2]
        lettered = script >= 0
        allowed = model.scripts[np.maximum(script, 0)]
        narrowed = lettered & allowed.any(1)
        out[narrowed] = np.where(allowed[narrowed], out[narrowed], out[narrowed] - 1e4)
        out[~lettered] = 0  # marks and numbers tell nothing
    return start, end, row, out


def viterbi(scores: np.ndarray, first: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Language of each word; texts are runs [first, first + count), all stepped together."""
    n_langs = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    active = np.searchsorted(-counts, -np.arange(1, (counts[0] if len(counts) else 0) + 1), "right")
    switched = np.zeros(scores.shape, bool)
    source = np.zeros(len(scores), np.int16)
    value = np.zeros((len(counts), n_langs), np.float32)
    for t, a in enumerate(active):
        at = first[:a] + t
        v = value[:a]
        if t:
            best = v.argmax(1)
            other = v[np.arange(a), best] - penalty
            change = v < other[:, None]
            switched[at], source[at] = change, best
            v = np.where(change, other[:, None], v)
            v -= v.max(1, keepdims=True)
        value[:a] = v + scores[at]
    label = np.zeros(len(scores), np.int16)
    now = value.argmax(1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        at = first[:a] + t
        label[at] = now[:a]
        change = switched[at, now[:a]]
        now[:a] = np.where(change, source[at], now[:a])
    return label


def _predict(model: Model, penalty: float, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kind = model.languages, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            data, offsets = textbytes.buffer_of(batch.column(1))
            for i, j in textbytes.pieces(offsets, PIECE):
                part, off = _spaced(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                start, end, row, scores = word_scores(model, part, off)
                n = j - i
                lettered = np.zeros(n, bool)
                lettered[np.unique(np.searchsorted(off, np.flatnonzero((part | 32) - np.uint8(97) < 26), "right") - 1)] = True
                for r in np.flatnonzero(~lettered):
                    lettered[r] = any(c.isalpha() for c in part[off[r] : off[r + 1]].tobytes().decode("utf-8", "replace"))
                langs, share, spans = ["und"] * n, np.zeros(n), [[] for _ in range(n)]
                if names and len(row):
                    counts = np.bincount(row, minlength=n)
                    label = viterbi(scores, np.concatenate(([0], np.cumsum(counts)[:-1])), counts, penalty)
                    weight = np.bincount(row * len(names) + label, weights=end - start, minlength=n * len(names)).reshape(n, len(names))
                    best = weight.argmax(1)
                    total = weight.sum(1)
                    told = np.bincount(row, weights=scores.any(1), minlength=n) > 0
                    share = np.where(told, weight[np.arange(n), best] / np.maximum(total, 1), 1 / len(names))
                    share = np.where(lettered & (total > 0), share, 0.0)
                    langs = [names[b] if ok else "und" for b, ok in zip(best, lettered)]
                    if with_spans:
                        cut = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (row[1:] != row[:-1]))))
                        last = np.concatenate((cut[1:], [len(row)])) - 1
                        for a, b in zip(cut, last):
                            r = row[a]
                            if lettered[r]:
                                spans[r].append({"start": int(start[a] - off[r]), "end": int(end[b] - off[r]), "lang": names[label[a]]})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(langs, pa.string()), pa.array(share), pa.array(spans, kind)], ["doc_id", "lang_pred", "score", "spans"])

    return run


def predict(docs: DataFrame, model: Model, penalty: float = SWITCH, with_spans: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score`` and spans (byte offsets, end exclusive) of each text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_predict(model, penalty, with_spans), PREDICTED)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for every document, learned from the rows that are not held out."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labelled = tables.documents(spark, sf_dir, "doc_id", "text", "lang").where(rest != 2)
    found = predict(tables.documents(spark, sf_dir), fit(labelled), with_spans=False)
    return found.select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_language_id": op4_language_id}
ORACLE_SQL: dict[str, str] = {}
