"""Page order, captions and exact round trips of stored payloads."""

import hashlib
import math
import statistics
import zlib
from collections import Counter

from stridelake.llm import media_columns as mc


def padded(text):
    data = (text or "").encode()
    return data + b" " * (-len(data) % 192 or (0 if data else 192))


def plain_feature(data):
    """The feature by loops over the bytes."""
    n = len(data)
    edges = [int(n * i / 64) for i in range(65)]
    means = [sum(data[a:b]) / (b - a) for a, b in zip(edges, edges[1:])]
    middle = statistics.median(means)
    bits = int("".join("1" if m > middle else "0" for m in means), 2)
    shares = [c / n for c in Counter(data).values()]
    entropy = -sum(s * math.log2(s) for s in shares) + 0.0
    return f"{bits:016x}:{statistics.fmean(data):.4f}:{statistics.pstdev(data):.4f}:{entropy:.4f}"


def test_sequence_keeps_order_and_captions():
    html = '<p>one <b>two</b></p><figure><img src="sha256:a" alt="x"><img src="b"><figcaption>both &amp; here</figcaption></figure>tail<script>no<p></script><img src=c alt="own">'
    assert mc.page_sequence(html) == [
        ("text", "one two", None, None), ("media", None, "sha256:a", "both & here"), ("media", None, "b", "both & here"), ("text", "tail", None, None), ("media", None, "c", "own"),
    ]
    assert mc.page_sequence("") == []


def test_store_and_resolve(spark):
    texts = {0: None, 1: "", 2: "x" * 192, 3: "é" * 500, 4: "x" * 192, 5: "word " * 20000}
    docs = spark.createDataFrame([(k, t, "n") for k, t in texts.items()], "doc_id long, text string, digest string")
    store = mc.media_store(docs, "text").collect()
    assert len(store) == 4
    for r in store:
        back = mc.from_png(bytes(r["media"])).tobytes()
        assert hashlib.sha256(back).hexdigest() == r["payload_sha256"] == r["digest"] and len(back) == r["payload_bytes"]
    docs.createOrReplaceTempView("d")
    import tempfile

    with tempfile.TemporaryDirectory() as d:
        docs.write.parquet(f"{d}/documents.parquet")
        rows = {r["doc_id"]: r for r in mc.op6_media_columns(spark, d).collect()}
    assert rows.keys() == texts.keys()
    for k, t in texts.items():
        r, p = rows[k], padded(t)
        media = mc.to_png(p)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(p[-16:]), len(media), hashlib.sha256(media).hexdigest())
        assert r["feature"] == plain_feature(p) and r["position"] == 1
    assert rows[0]["feature"] == rows[1]["feature"] and rows[2]["feature"] == rows[4]["feature"]


def test_sequences_resolve_in_page_order(spark):
    """Every media reference of interleaved pages meets its stored file; positions and captions stay aligned."""
    payloads = spark.createDataFrame([("one",), ("two",), ("two",), (None,)], "t string")
    names = {t: hashlib.sha256(padded(t)).hexdigest() for t in ("one", "two", None)}
    page = f"<p>a</p><img src=sha256:{names['one']} alt=first>b<figure><img src=sha256:{names['two']}><p>c</p><img src=sha256:{names[None]}><figcaption>both</figcaption></figure><img src=elsewhere>"
    pages = spark.createDataFrame([(1, page, "x"), (1, page, "x"), (None, page, "x"), (2, None, "x")], "id long, html string, digest string")
    rows = mc.resolve(mc.parse_sequences(pages, "id", "html"), mc.media_store(payloads, "t"), "key").collect()
    expected = [(0, "a", None, None), (1, None, "first", "one"), (2, "b", None, None), (3, None, "both", "two"), (4, "c", None, None), (5, None, "both", None), (6, None, None, "-")]
    for key, copies in ((1, 2), (None, 1)):
        own = sorted((r for r in rows if r["key"] == key), key=lambda r: r["position"])
        assert len(own) == 7 * copies
        for i, r in enumerate(own):
            position, text, caption, payload = expected[i // copies]
            assert (r["position"], r["text"], r["caption"]) == (position, text, caption)
            if text is None and payload != "-":
                assert mc.from_png(bytes(r["media"])).tobytes() == padded(payload) and r["payload_sha256"] == names[payload]
            else:
                assert r["media"] is None
    assert {r["key"] for r in rows} == {1, None}


def test_unknown_digest_keeps_nulls(spark):
    refs = spark.createDataFrame([(1, "0" * 64), (2, None)], "key long, digest string")
    store = mc.media_store(spark.createDataFrame([("a",)], "t string"), "t")
    assert [(r["key"], r["media"]) for r in mc.resolve(refs, store, "key").orderBy("key").collect()] == [(1, None), (2, None)]
