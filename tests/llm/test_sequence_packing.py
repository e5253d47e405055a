"""Packing: gapless sequences, every piece once, and near the lower bound."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

tokenizers = pytest.importorskip("tokenizers")
from stridelake.llm import sequence_packing as sp  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def expand(plan):
    return [list(p) for p, n in plan for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_every_item_near_the_bound(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(30, 60), 97, 100]) for _ in range(2000)]
    histogram = {s: sizes.count(s) for s in set(sizes)}
    bins = expand(sp.packing_plan(histogram, 100))
    assert sorted(x for b in bins for x in b) == sorted(sizes)
    assert max(map(sum, bins)) <= 100
    lower = max(-(-sum(sizes) // 100), sum(s > 50 for s in sizes))
    assert len(bins) <= lower * 1.05 + 1


def test_reduction_keeps_the_optimum():
    """Against exhaustive search on small instances."""

    def optimum(items, cap):
        best = [len(items)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(items):
                best[0] = len(bins)
                return
            for j in range(len(bins)):
                if bins[j] + items[i] <= cap:
                    bins[j] += items[i]
                    go(i + 1, bins)
                    bins[j] -= items[i]
            go(i + 1, [*bins, items[i]])

        go(0, [])
        return best[0]

    rng = random.Random(7)
    for _ in range(150):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 8))), reverse=True)
        count = np.bincount(items, minlength=13).astype(np.int64)
        fixed = expand(sp.reduce_by_dominance(count, 12))
        rest = [s for s in range(12, 0, -1) for _ in range(count[s])]
        assert len(fixed) + (optimum(rest, 12) if rest else 0) == optimum(items, 12)


def test_pieces_and_places(spark):
    texts = {0: None, 1: "", 2: "Hello World " * 900, 3: "a\x1cb  c", 4: "don't É x <|endoftext|> 12", 5: "one two", 6: "one two"}
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, length int")
    pieces = sp.token_pieces(docs, PATH, capacity=64)
    rows = sp.pack(pieces.cache(), 64).collect()
    t = tokenizers.Tokenizer.from_file(PATH)
    for k, text in texts.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [(i, s, min(64, len(ids) - s)) for i, s in enumerate(range(0, len(ids), 64))]
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes()) for s in range(0, len(ids), 64)]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    whole = {r["sequence_id"]: (r["n_ids"], len(r["ids"]) // 4) for r in sp.sequences(sp.pack(pieces, 64)).collect()}
    assert all(a == b for a, b in whole.values()) and len(whole) == len(by)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.pack(sp.token_pieces(docs, PATH)).count() == 0


def test_bulk_words_equal_the_tokenizer():
    import duckdb

    texts = [t or "" for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    words = sorted({w for t in texts for w in t.split()})[::3] + ["É's", "ẞtraße", "İx", "漢字ab", "a\x01b", "don't've", "x1_2y", "ΣΑΣ", "é́"]
    known = sp.TextIds(PATH)
    t = tokenizers.Tokenizer.from_file(PATH)
    for some in (words, texts, ["", *(" ".join(words[k::97]) + "\u2028\xa0x" for k in range(97)), "a\x02 b\x02 漢 c", ""]):
        for w, got, e in zip(some, known.ids(some), t.encode_batch_fast(some, add_special_tokens=False)):
            assert np.frombuffer(got, "<u4").tolist() == e.ids, w


def test_added_tokens_as_the_tokenizer_takes_them(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "x<|startoftext|>y", "a <|ENDOFTEXT|> b", "<|", "<|endoftext|>" * 3, "no token", "a\x1c<|endoftext|>\x1fb", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sp.token_pieces(docs, path).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*plain.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0]


def test_numbers_are_dealt_out_and_clashing_names_pass(spark, monkeypatch):
    monkeypatch.setattr(sp, "NUMBERED", 7)
    rows = [(k // 3, k % 3, 0, 1 + k % 4 * 300, k, "a", "b") for k in range(200)] + [(None, 0, 0, 5, 5, "a", "b")] * 3
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, _salt int, _own string, row string")
    out = sp.pack(pieces).collect()
    assert len(out) == 203 and sorted(str(tuple(r)[:7]) for r in out) == sorted(map(str, rows))
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= sp.CAPACITY
