"""Chunked encoding against the library on whole texts, and the exact round trip."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

regex = pytest.importorskip("regex")
from stridelake.llm import byte_bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = {
    0: None, 1: "", 2: "Hello, it's   a  test\n\n  of I'redo 123 4567  ", 3: "word " * 400, 4: "x" * 900 + " y's " + " " * 700 + "z",
    5: "é ü 漢字 👍🏽 don't\t\tstop" * 40, 6: " " * 500, 7: "a" * 2000, 8: "'s't're" * 150 + "12" * 300,
}


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (100, 200), (37, 1)])
def test_stitched_chunks_equal_the_whole(spark, chunk, overlap):
    codec = byte_bpe.Codec(PATH, public_tokenizers.PATTERN)
    docs = spark.createDataFrame([(k, t, "x") for k, t in TEXTS.items()], "doc_id long, text string, ids string")
    coded = byte_bpe.encode(docs, PATH, dealt=(chunk, overlap))
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in coded.collect()}
    assert got == {k: codec.encode(t or "") for k, t in TEXTS.items()}
    back = {r["doc_id"]: bytes(r["data"]) for r in byte_bpe.decode(coded, PATH).collect()}
    assert back == {k: (t or "").encode() for k, t in TEXTS.items()}


@pytest.mark.parametrize("chunk,overlap", [(16, 4), (64, 16), (37, 1), (100, 200), (byte_bpe.CHUNK, byte_bpe.OVERLAP)])
def test_pieces_of_chunks_equal_the_whole(chunk, overlap):
    """Every text, cut at meeting places only; the corpus texts really are cut."""
    codec, find = byte_bpe.Codec(PATH, public_tokenizers.PATTERN), regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(chunk)
    alphabet = [*"aB'sltd  \n\t\r01.,!-é漢字👍🏽", " ", "'ll", "\r\n", "  ", "word"]
    texts = [t or "" for t in TEXTS.values()] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    texts += pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    for t in texts:
        assert byte_bpe.encode_in_chunks(codec, find, t, chunk, overlap) == codec.encode(t)
    at = [byte_bpe.cuts(find, t, chunk, overlap) for t in texts]
    assert sum(len(a) - 1 for a in at) > sum(len(t) for t in texts) / chunk / 2


def test_digests_and_empty_table(spark):
    docs = spark.createDataFrame([(k, t) for k, t in TEXTS.items()], "doc_id long, text string")
    codec = byte_bpe.Codec(PATH, public_tokenizers.PATTERN)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.encode_digests(docs, PATH, dealt=(128, 32)).collect()}
    assert got == {k: codec.digests(codec.encode(t or "")) for k, t in TEXTS.items()}
    assert byte_bpe.encode_digests(docs.where("false"), PATH).count() == 0


def test_long_rows_with_null_and_repeated_ids(spark):
    codec = byte_bpe.Codec(PATH, public_tokenizers.PATTERN)
    rows = [(None, TEXTS[3]), (None, TEXTS[5]), (5, TEXTS[7]), (5, TEXTS[7]), (5, TEXTS[8]), (None, "short"), (None, "short"), (None, None)]
    coded = byte_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PATH, dealt=(64, 16))
    key = lambda r: (str(r[0]), r[1])
    got = [(r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in coded.collect()]
    assert sorted(got, key=key) == sorted(((d, codec.encode(t or "")) for d, t in rows), key=key)
