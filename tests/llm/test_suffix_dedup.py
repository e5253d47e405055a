"""Substring dedup against brute force."""

import hashlib
import random

from stridelake.llm import suffix_dedup as sd


def brute(texts, width):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256)."""
    first = {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        for i in range(len(data) - width + 1):
            first.setdefault(data[i : i + width], d)
    out = {}
    for d, text in texts.items():
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < d:
                gone[i : i + width] = b"\1" * width
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    passage = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(10, 60))) for _ in range(6)]
    texts = {0: None, 1: "", 2: "a" * 300, 3: "b" + "a" * 200, 4: "ab" * 100, 5: "short"}
    for d in range(6, n):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passage)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, 3), p[a : len(p) - rng.randint(0, len(p) // 3)])
        texts[d] = "".join(parts)
    texts[n], texts[n + 1], texts[n + 2] = texts[20], texts[20], texts[30] + texts[40]
    return texts


def test_equals_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        docs = spark.createDataFrame([(d, t, 0) for d, t in texts.items()], "doc_id long, text string, block int")
        rows = sd.dedup(docs, block_bytes=2000).collect()
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
        assert got == brute(texts, 50)
        assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "the same words again and again, long enough to count as a repeat"
    docs = spark.createDataFrame([(7, text), (7, text), (None, text), (9, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in sd.dedup(docs).collect())
    assert got == [(-1, len(text)), (7, 0), (7, 0), (9, len(text))]
    assert sd.dedup(docs.where("false")).count() == 0


def test_groups_list_all_occurrences(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(30))
    texts = {d: f"{word()} {word()} {passage} {word()} {word()}" for d in range(12)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = sd.repeat_groups(docs).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["repeat_id"], []).append(r)
    whole = 0
    for own in groups.values():
        said = {texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["length"]] for r in own}
        assert len(said) == 1 and len(said.pop()) >= 50
        assert {r["first_doc_id"] for r in own} == {min(r["doc_id"] for r in own)}
        whole += {r["doc_id"] for r in own} == set(texts)
    assert whole


def test_groups_have_full_length_and_know_one_block(spark):
    """A passage of over 200 bytes in three documents, and one twice in a single document, as one group each."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    shared, twice = (" ".join(word() for _ in range(30)) for _ in range(2))
    own = lambda n: " ".join(word() for _ in range(n))
    texts = {d: f"{own(d % 5 + 3)} A{shared}Z{d} {own(4)}" for d in (3, 8, 13)} | {20: f"{own(2)} <{twice}> {own(9)} ({twice}) {own(2)}", 21: own(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    groups = {}
    for r in sd.repeat_groups(docs).collect():
        groups.setdefault(r["repeat_id"], set()).add((r["doc_id"], r["start"], r["length"]))
    expected = {
        frozenset((d, texts[d].index(" A" + shared), len(shared) + 3) for d in (3, 8, 13)),
        frozenset((20, i, len(twice)) for i in (texts[20].index(twice), texts[20].rindex(twice))),
    }
    assert {frozenset(g) for g in groups.values()} == expected


def test_interval_tree():
    assert sorted(sd.interval_tree([0, 3, 5, 5, 2, 0, 4], 2)) == [(2, 0, 5), (3, 0, 4), (4, 5, 7), (5, 1, 4)]


def test_cleaned_keeps_columns_and_whole_characters(spark):
    text = "é" * 24 + "abcdefgh" * 6
    docs = spark.createDataFrame([("en", 1, text + "tail", 5), ("fr", 2, "©" + text[1:] + " own", 6), ("x", None, None, None)], "lang string, doc_id int, text string, doc int")
    out = sd.cleaned(docs)
    assert out.dtypes == docs.dtypes
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[1] == text + "tail" and got[None] == "" and got[2] == " own"
