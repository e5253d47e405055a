"""Roots, proofs and tampered roots against a plain recursion over sorted lists."""

import hashlib
import random
import zlib

import pytest

from stridelake.llm import merkle_manifest as mm

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """(root, siblings left and right of each leaf's way)."""
    if len(digests) == 1:
        return digests[0], [[]]
    runs = [digests[i : i + 3] for i in range(0, len(digests), 3)]
    root, above = tree([sha("".join(run)) for run in runs])
    return root, [[("".join(run[:k]), "".join(run[k + 1 :])), *above[i]] for i, run in enumerate(runs) for k in range(len(run))]


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        done[name] = (ordered, *tree([leaf_of(r) for r in ordered]))
    root, above = tree([done[name][1] for name in names])
    out = []
    for name, upper in zip(names, above):
        ordered, subroot, proofs = done[name]
        for row, proof in zip(ordered, proofs):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            own = leaf_of((*row[:4], text))
            for left, right in proof + upper:
                own = sha(left + own + right)
            out.append((row[0], leaf_of(row), subroot, root, sha("".join(a + b for a, b in proof + upper)), own, own == root))
    return sorted(out, key=str)


def query(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return sorted((tuple(r) for r in mm.op11_merkle_manifest(spark, str(folder)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def rows_of(sizes):
    rng = random.Random(3)
    return [(rng.randrange(10**6), source, rng.choice(["en", None]), rng.choice([None, 7]), rng.choice([None, "", "a\nb", "c\n", "é\n\nz", "plain"])) for source, n in sizes.items() for _ in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1, "": 4}, {"a": 3, "é": 10, "b": 28}, {f"s{i}": 1 + i % 5 for i in range(13)}])
def test_small_tables(spark, tmp_path, sizes):
    rows = rows_of(sizes)
    assert query(spark, tmp_path, rows) == plain(rows)


def test_blocks_of_a_hot_group_and_repeated_rows(spark, tmp_path, monkeypatch):
    whole = mm.manifest
    monkeypatch.setattr(mm, "manifest", lambda *a: whole(*a, levels=2))
    rows = rows_of({"hot": 300, "b": 9, "c": 10, **{f"s{i}": 1 for i in range(30)}})
    rows += rows[:40] + [(None, "hot", None, None, "x\n"), (None, None, None, None, None), (5, "hot", "en", 1, "t"), (5, "hot", "en", 1, "u")]
    assert query(spark, tmp_path, rows) == plain(rows)


def test_whole_block_size(spark, tmp_path):
    rows = rows_of({"hot": 3**mm.LEVELS + 5, "full": 3**mm.LEVELS})
    assert query(spark, tmp_path, rows) == plain(rows)


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == []


def test_joins_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mm, "BROADCAST_ROWS", 0)
    rows = rows_of({"a": 40, "b": 3, None: 2})
    assert query(spark, tmp_path, rows) == plain(rows)


def test_clashing_columns_pass_and_proofs_fold(spark):
    df = spark.createDataFrame([(k, "g", f"{k:064x}", k * 2, "x", [k], "old") for k in range(11)], "key int, label string, digest string, idx int, tree string, row array<int>, root string")
    out = mm.manifest(df, "digest", "label", "key")
    assert out.columns == ["key", "label", "digest", "idx", "tree", "row", "subroot", "root", "proof"]
    for r in out.withColumn("again", mm.fold(out["digest"], out["proof"])).collect():
        assert r["again"] == r["root"] == r["subroot"] and r["idx"] == 2 * r["key"] and r["row"] == [r["key"]] and len(r["proof"]) == 3


def test_sweeps_agree_with_the_recursion():
    for n in range(1, 90):
        digests = [sha(str(i)) for i in range(n)]
        families, top = mm.forward(digests, mm.height(n, 9))
        assert (top, mm.backward(families, mm.height(n, 9), [], n)) == tree(digests)
