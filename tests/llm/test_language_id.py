"""Held-out accuracy, spans of mixed texts and Viterbi against a plain loop."""

import numpy as np

from stridelake.llm import language_id as li
from tests.conftest import DATA


def test_viterbi_equals_plain_dynamic_programming():
    rng = np.random.default_rng(0)
    counts = np.array([5, 0, 12, 1])
    scores = rng.normal(0, 3, (counts.sum(), 3)).astype(np.float32)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    label = li.viterbi(scores, first, counts, 2.0)
    for f, n in zip(first, counts):
        best = None
        if n:
            def total(path):
                return sum(scores[f + t, s] for t, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
            value = [(scores[f, s], [s]) for s in range(3)]
            for t in range(1, n):
                value = [max(((v - 2.0 * (p[-1] != s) + scores[f + t, s], [*p, s]) for v, p in value), key=lambda x: x[0]) for s in range(3)]
            best = max(v for v, _ in value)
            assert abs(total(list(label[f : f + n])) - best) < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text")
    rows = li.op4_language_id(spark, DATA).join(docs, "doc_id").where("held_out AND length(text) > 40").collect()
    assert len(rows) > 20 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges_and_spans(spark):
    en, ru = "the quick brown fox jumps over it", "быстрая лиса прыгает через это"
    model = li.fit(spark.createDataFrame([(en * 20, "en", 0), (ru * 20, "ru", 0), ("xx", None, 0)], "text string, lang string, score int"))
    assert model.languages == ["en", "ru"]
    docs = spark.createDataFrame([(0, None, "a"), (1, "", "a"), (2, "123 !! 😀", "a"), (3, f"{en} {ru}", "a"), (4, "лиса", "a"), (5, en + " " + en * 3000, "a")], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in li.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["und", "und", "und", "ru", "ru", "en"]
    assert [(s["start"], s["end"], s["lang"]) for s in got[3]["spans"]] == [(0, len(en), "en"), (len(en) + 1, len(f"{en} {ru}".encode()), "ru")]
    assert not got[2]["spans"] and got[2]["score"] == 0
    none = li.Model([], np.zeros((0, li.BUCKETS), np.float32), np.zeros((9, 0), bool))
    assert {r["lang_pred"] for r in li.predict(docs, none).collect()} == {"und"}
    assert li.predict(docs.where("false"), model).count() == 0


def test_signs_are_no_letters_and_unknown_letters_tell_nothing(spark):
    model = li.fit(spark.createDataFrame([("the quick brown fox " * 20, "en"), ("le renard brun et rapide " * 20, "fr")], "text string, lang string"))
    texts = ["× 5 ÷ 3", "12 × 7", "ქართული ენა", "é", "the quick ქართული fox", "the fox", "the fox"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in li.predict(docs, model).collect()}
    assert got[0] == got[1] == ("und", 0.0)
    assert got[2] == ("en", 0.5) and got[3][0] in ("en", "fr")
    assert got[4][0] == "en" and got[4][1] == 1.0
    assert got[5] == got[6]  # repeated rows are judged alike


def test_ties_go_to_the_first_language(spark):
    same = "word after word " * 20
    model = li.fit(spark.createDataFrame([(same, "b"), (same, "a")], "text string, lang string"))
    assert li.predict(spark.createDataFrame([(1, "word after")], "doc_id long, text string"), model).first()["lang_pred"] == "a"
