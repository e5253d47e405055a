"""Verdicts against a loop over all rules."""

import random

import pytest

from stridelake.llm import url_filters as uf

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    stop = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if c in UPPER else c for c in rest[:end]), rest[end:stop] if stop >= end else ""


def plain(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://org", "https://org/", "http://A.ORG/x?y#z", "ftp://example.org/en/123#q", "http://w.example.org/es/", "http://notexample.org/es/1", "http://example.org?x=/es/",
    "http://example.org#/es/", "x://.org/", "x://a..org//", "http://É.com/fr/é", "http://com/de/" + "x" * 50_000, "http://b.com/DE/", "http://" + "a." * 3000 + "com/de/1", "http://org./x", "a://b://c.com/fr/", "http://c.com:80/fr/",
    "http://line\nbreak.org/\n/x", "http://example.org/en/1",
]


@pytest.mark.parametrize("bound", [uf.BROADCAST_ROWS, 0])
def test_query_rules(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(uf, "BROADCAST_ROWS", bound)
    rows = [(k, u, "x") for k, u in enumerate(URLS)] + [(3, "http://a.com/fr/", "x"), (3, "http://a.com/fr/", "x"), (None, "http://a.com/de/", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = [tuple(r) for r in uf.op12_url_filters(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(out, key=str) == sorted(((k, *plain(u, uf.QUERY_RULES)) for k, u, _ in rows), key=str)


def test_many_rules_with_ties_and_nulls(spark):
    rng = random.Random(1)
    names = ["a", "b.a", "c.b.a", "bb", ""]
    paths = ["", "/", "/x", "/x/", "/x/yy", "/y"]
    rules = [(rng.choice(names), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(12)] + [(None, "/", "block"), ("a", None, "block"), ("a", "/", None)]
    urls = [f"s://{h}{p}{t}" for h in ("a", "b.a", "x.c.b.a", "bb", "cc", "ab.a") for p in paths for t in ("", "z", "/", "?q")]
    df = spark.createDataFrame([(u, 1, "r", [2]) for u in urls] * 2, "url string, short int, row string, full array<int>")
    out = uf.judge(df, spark.createDataFrame(rules, uf.RULES))
    assert out.columns == ["url", "short", "row", "full", "host", "path", "rule", "verdict"]
    got = sorted((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect() if r["short"] == 1 and r["row"] == "r" and r["full"] == [2])
    assert got == sorted([(u, *plain(u, rules)) for u in urls] * 2)


def test_no_rules_and_empty_table(spark):
    df = spark.createDataFrame([("s://a/b",), (None,)], "url string")
    none = spark.createDataFrame([], uf.RULES)
    assert {r["verdict"] for r in uf.judge(df, none, default="block").collect()} == {"block"}
    assert uf.judge(df.limit(0), spark.createDataFrame(uf.QUERY_RULES, uf.RULES)).collect() == []


def test_short_prefixes_are_confirmed(spark, monkeypatch):
    """With a prefix of no digits every expression meets every rule; the digests alone decide."""
    monkeypatch.setattr(uf, "SHORT", 0)
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    out = uf.judge(df, spark.createDataFrame(uf.QUERY_RULES, uf.RULES)).collect()
    assert sorted(((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out), key=str) == sorted(((u, *plain(u, uf.QUERY_RULES)) for u in URLS), key=str)
