"""Components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from stridelake.llm import jaccard_join as jj

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = {d: shingle_set(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in texts}


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") * rng.randint(1, 3) + rng.choice("qrstuv")
    passage = [word() for _ in range(40)]
    texts = {0: None, 1: "", 2: " \n", 3: "One two", 4: "one TWO", 5: "one two three"}
    bases = [[word() for _ in range(rng.choice([6, 9, 15, 30, 80, 200]))] for _ in range(12)]
    for d in range(6, n):
        if rng.random() < 0.75:
            w = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                i = rng.randrange(len(w))
                w[i : i + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
        else:
            w = [word() for _ in range(rng.randint(10, 90))]
        if rng.random() < 0.3:
            w[len(w) // 2 : len(w) // 2] = passage
        texts[d] = " ".join(w)
    return texts


@pytest.mark.parametrize("seed,cell", [(1, 4096), (2, 7)])
def test_components_equal_brute_force(spark, monkeypatch, seed, cell):
    """Also with keys that are cut into cells."""
    monkeypatch.setattr(jj, "CELL", cell)
    texts = corpus(seed, 300)
    docs = spark.createDataFrame([(d, t, 0) for d, t in texts.items()], "doc_id long, text string, size int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jj.similar(docs).collect()}
    assert got == brute(texts)


def test_every_link_shares_a_searched_key():
    """The filter alone, on random sets of all sizes."""
    rng = np.random.default_rng(3)
    rows, names, links = [], [], []
    for k in range(600):
        size = int(rng.integers(1, 120))
        base = rng.integers(1, 2**62, size).astype(np.uint64)
        partner_size_change = int(rng.integers(0, size // 7 + 1))
        drop = rng.permutation(size)[: size - partner_size_change]
        other = np.concatenate((base[drop], rng.integers(1, 2**62, int(rng.integers(0, size // 7 + 1))).astype(np.uint64)))
        rows += [np.full(size, 2 * k), np.full(len(other), 2 * k + 1)]
        names += [base, other]
        both = len(np.intersect1d(base, other))
        if both and 100 * both >= 75 * (size + len(other) - both):
            links.append(2 * k)
    row, name = jj.textbytes.distinct_pairs(np.concatenate(rows), np.concatenate(names))
    owner, key, searched = jj.signatures(row, name, 1200)
    assert len(links) > 200
    for x in links:
        a, b = owner == x, owner == x + 1
        assert set(key[a & searched]) & set(key[b]) or set(key[b & searched]) & set(key[a]), x


def test_repeated_rows_and_null_ids(spark):
    texts = corpus(5, 40)
    rows = [(d, t, 0) for d, t in texts.items()]
    docs = spark.createDataFrame(rows + rows[6:20] + [(None, texts[7], 0)], "doc_id long, text string, set_id int")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.similar(docs).collect())
    expected = brute(texts)
    assert got == sorted((d, *expected[d]) for d in [r[0] for r in rows + rows[6:20]])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jj.similar(docs).count() == 0


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for size in (1, 20, 33, 64, 65, 300):
        for _ in range(20):
            base = rng.integers(1, 2**62, size).astype(np.uint64)
            other = np.unique(np.concatenate((base[int(size / 8) :], rng.integers(1, 2**62, int(rng.integers(0, size // 6 + 1))).astype(np.uint64))))
            base = np.unique(base)
            differ = len(np.setxor1d(base, other))
            row = np.repeat([0, 1], [len(base), len(other)])
            x, y = jj.parity_sketches(row, np.concatenate((base, other)), np.array([len(base), len(other)]))
            far = jj.too_far([x], [y], np.array([7 * differ]))
            assert not far[0]
    far = rng.integers(1, 2**62, 400).astype(np.uint64)
    x, y = jj.parity_sketches(np.repeat([0, 1], 200), far, np.array([200, 200]))
    assert jj.too_far([x], [y], np.array([400]))[0]
