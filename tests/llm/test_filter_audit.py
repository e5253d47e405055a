"""Totals of all orders against a loop that removes documents one by one."""

import random
import re
from itertools import permutations

from stridelake.llm import filter_audit as fa


def fails(rows):
    """(part, doc_id, set of failed filters) of each row."""
    out = []
    for doc_id, lang, text in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = set()
        failed |= {"A"} if len(words) < 100 else set()
        failed |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        failed |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        failed |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        failed |= {"E"} if doc_id is not None and any(other is not None and other < doc_id and (said or "") == t for other, _, said in rows) else set()
        out.append((lang or "", doc_id, failed))
    return out


def plain(rows, labels):
    judged, out = fails(rows), []
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for part in {p for p, _, _ in judged}:
        own = [(d, f) for p, d, f in judged if p == part]
        shapley, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = list(own)
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(gone)
                redundant = sum(x in f for _, f in own) - len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), redundant, sum(f == {x} for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), x))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out)


def text_of(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return rng.choice([None, "", "few words", "BIG $"])
    words = [f"w{rng.randrange(60 if kind == 1 else 10**6)}" for _ in range(rng.choice([90, 150]))]
    return rng.choice([" ", "\n", "\u00a0 "]).join(w.upper() * 2 if kind == 2 else w for w in words) + (" #" if kind == 3 else "")


def run(spark, folder, rows, labels):
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, lang string, text string, part string, mask int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out = fa.op13_filter_audit(spark, str(folder)).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return sorted(tuple(r) for r in out.collect())


def test_all_orders(spark, tmp_path):
    rng = random.Random(5)
    texts = [text_of(rng) for _ in range(40)]
    rows = [(k, rng.choice(["en", "de", None, ""]), rng.choice(texts)) for k in range(150)] + [(None, "en", texts[0]), (None, None, None), (7, "xx", "a " * 50_000)]
    rows += rows[:10]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    assert run(spark, tmp_path, rows, labels) == plain(rows, labels)


def test_empty_tables(spark, tmp_path):
    assert run(spark, tmp_path, [], []) == []


def test_one_document_without_labels(spark, tmp_path):
    rows = [(1, None, None)]
    got = run(spark, tmp_path, rows, [])
    assert got == plain(rows, []) and len(got) == 600


def test_ranks_are_places_in_order():
    assert [fa.lehmer_rank(p, 5) for p in permutations(range(5))] == list(range(120))
    assert fa.lehmer_rank((2,), 5) == 48 and fa.lehmer_rank((2, 0), 5) == 48 and fa.lehmer_rank((2, 4), 5) == 66
