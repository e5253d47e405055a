"""Each stage on its own input, against brute force, at the smallest scale."""

import random

import corpus_pipeline
from stridelake.llm import personal_data, sequence_packing
from tests.conftest import DATA
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_suffix_dedup import brute as repeats


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        new = out.collect()
        before, after = {r["doc_id"]: r["text"] for r in rows}, {r["doc_id"]: r["text"] for r in new} if k < 4 else {}
        if k < 4:
            assert out.columns == columns and all(r["n_chars"] == len(r["text"]) for r in new)
        if k == 0:
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
            assert all(d not in after for d, q in labels.items() if q == 0)
            assert all(d in after for d, q in labels.items() if q == 1 and len(before[d].split()) >= 50)
        if k == 1:
            assert set(after) == {d for d, (_, c) in components(before).items() if c == d}
            assert all(after[d] == before[d] for d in after)
        if k == 2:
            found = repeats(before, 50)
            assert set(after) == set(before)
            for d, (n, removed, _, _) in found.items():
                assert n - removed - 3 * 40 <= len(after[d].encode()) <= n - removed
                assert removed or after[d] == before[d]
        if k == 3:
            assert set(after) == set(before)
            assert not any(personal_data.base_entities(t) for t in after.values())
        if k == 4:
            assert {r["doc_id"] for r in new} == set(before)
            assert max(r["offset"] + r["length"] for r in new) <= sequence_packing.CAPACITY
        docs, rows = out, new


def written(spark, folder, rows):
    """A documents table with columns whose names the stages use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int, kept string, row string, piece int"
    spark.createDataFrame([(*r, 7, "k", "r", 3) for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_nulls_odd_texts_and_extra_columns(spark, tmp_path):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)) + "."

    one, shared = prose(120), prose(30)
    rows = [
        (1, one, "en", "s", 1), (2, one, "en", "s", 1), (3, one + " " + prose(3), None, None, None), (4, prose(100) + "\n" + shared, "en", "s", 1), (5, prose(100) + "\n" + shared, "en", "s", 1),
        (6, prose(80) + " mail me@example.org now.", "en", "s", 1), (7, prose(40_000), "de", "t", 1), (8, None, "en", "s", 1), (9, "", "en", "s", 1), (10, "too short", "en", "s", 1), (None, prose(90), "en", "s", 1), (11, prose(60), "en", "s", 1), (11, prose(60), "en", "s", 1),
    ]
    out = corpus_pipeline.run(spark, written(spark, tmp_path, rows)).collect()
    ids = {r["doc_id"] for r in out}
    # Copies go, and so do texts that the rules reject; a null id and two texts of one id stay.
    assert ids == {1, 4, 5, 6, 7, None, 11}
    assert sum(r["doc_id"] == 11 and r["piece"] == 0 for r in out) == 2
    long = sorted((r["piece"], r["start"], r["length"]) for r in out if r["doc_id"] == 7)
    assert len(long) > 20 and all(s == sum(n for _, _, n in long[:k]) for k, (_, s, _) in enumerate(long)) and all(n == sequence_packing.CAPACITY for _, _, n in long[:-1])
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and min(own)[0] == 0


def test_empty_table(spark, tmp_path):
    out = corpus_pipeline.run(spark, written(spark, tmp_path, []))
    assert out.collect() == [] and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
