"""Components against union-find on chains, stars and random links."""

import random

from stridelake.llm import components as cc


def plain(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    cases = [
        [(1, 2), (1, 3), (1, 4), (9, 8)], [(i, i + 1) for i in range(40)], [(40 - i, 39 - i) for i in range(0, 40, 2)],
        [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)], [],
    ]
    for links in cases:
        links = [(a, b) for a, b in links if a != b]
        got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == plain(links)
