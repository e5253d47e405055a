"""Merkle manifest of a table: a digest tree of each group, a tree over the groups, proofs.

Leaves ascend by their key within a group; every three consecutive nodes (the last run of a
level may have fewer, even one) become their digest until one node, the subroot, is left.
The subroots, ordered by group, become the root in the same way.

The tree is evaluated by time-forward processing.  Nodes are labelled by level and index; a
digest is a message to the label of its parent.  Messages wait in a priority queue ordered
by label, so a parent finds its children's digests together and first in the queue when its
turn comes.  A reversed sweep then hands every child the digests of its run and its
parent's proof, and leaves receive whole proofs.  The queue is external: within a block of
3^7 nodes it is a heap in a task, and between blocks it is a shuffle by (tree, block), so no
task holds more than one block however large a group is.  Each round makes the number of
nodes 2,187 times smaller.

Places within a group come from a range partitioning: a row's place is its place in its
partition plus the counts of the group's earlier partitions, so a hot group is spread over
as many tasks as it has rows for.  Only rows of (partition, group) are summed by group.

Edge cases: null groups come first and null keys first in their group; the digest orders
rows with equal keys, so repeated rows give one tree whatever their order.  Null fields
count as such, and an empty text is no null.  A group of one row has its leaf as subroot
and one group its subroot as root.  An empty table gives an empty result.  All other input
columns pass untouched, whatever their names; result columns replace input columns of the
same name.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm import tables

#: Nodes in a run, and levels of a block.
ARITY, LEVELS = 3, 7
PROOF = "array<struct<left: string, right: string>>"
_PROOF = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
#: Rows of (partition, group) are broadcast up to this number; beyond it they are shuffled.
BROADCAST_ROWS = 200_000

Steps = list[tuple[str, str]]


def digest(children: list[str]) -> str:
    """Lowercase hex SHA-256 of digests, concatenated as hex text."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def row_digest(*columns: Column) -> Column:
    """Digest of a row: each value as its byte count, a colon and itself, or a dash for null."""
    said = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in said)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def forward(digests: list[str], levels: int) -> tuple[dict[tuple[int, int], list[str]], str]:
    """Children's digests by the label (level, index) of each parent, in the order of labels, and the top."""
    queue = [(1, i // ARITY, i, d) for i, d in enumerate(digests)]  # sorted, and so a heap
    families: dict[tuple[int, int], list[str]] = {}
    top = digests[0]
    while levels and queue:
        label = queue[0][:2]
        children = []
        while queue and queue[0][:2] == label:
            children.append(heappop(queue)[3])
        families[label] = children
        top = digest(children)
        level, index = label
        if level < levels:
            heappush(queue, (level + 1, index // ARITY, index, top))
    return families, top


def backward(families: dict[tuple[int, int], list[str]], levels: int, above: Steps, n: int) -> list[Steps]:
    """Proof of each of the ``n`` lowest nodes; ``above`` is the proof of the top."""
    ways: dict[tuple[int, int], Steps] = {(levels, 0): above}
    for (level, index), children in reversed(families.items()):
        own = ways.pop((level, index))
        for k in range(len(children)):
            ways[level - 1, index * ARITY + k] = [("".join(children[:k]), "".join(children[k + 1 :])), *own]
    return [ways[0, i] for i in range(n)]


def height(nodes: int, most: int) -> int:
    """Levels that a block climbs in a tree of so many nodes: ``most``, or as many as leave one node."""
    levels = 0
    while levels < most and ARITY**levels < nodes:
        levels += 1
    return levels


def _climb_block(most: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        n = block.column("n")[0].as_py()
        _, top = forward(block.column("digest").to_pylist(), height(n, most))
        return pa.table({"tree": block.column("tree")[:1], "idx": block.column("block")[:1], "n": pa.array([-(-n // ARITY**most)], pa.int64()), "digest": [top]})

    return run


def _descend_block(most: int):
    def run(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        digests, levels = block.column("digest").to_pylist(), height(block.column("n")[0].as_py(), most)
        said = [(s["left"], s["right"]) for s in above.column("proof")[0].as_py()]
        proofs = backward(forward(digests, levels)[0], levels, said, len(digests))
        flat = [step for proof in proofs for step in proof]
        steps = pa.StructArray.from_arrays([pa.array([s[k] for s in flat], pa.string()) for k in (0, 1)], ["left", "right"])
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in proofs]))).astype(np.int32)
        out = block.select([c for c in block.column_names if c not in {"block", "n"}])
        out = out.append_column("proof", pa.ListArray.from_arrays(pa.array(offsets), steps).cast(_PROOF))
        return out.append_column("top", pa.array([above.column("top")[0].as_py()] * len(digests), pa.string()))

    return run


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {ARITY**levels}"))


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Rounds of the forward sweep over ``tree, idx, n, digest``; the last has one node a tree.

    ``n`` counts the nodes of the tree.  Rounds after the first are written.
    """
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        low = _in_blocks(rounds[-1].select("tree", "idx", "n", "digest"), levels)
        rounds.append(tables.cut(low.groupBy("tree", "block").applyInArrow(tables.lean(_climb_block(levels)), "tree long, idx long, n long, digest string")))
    return rounds


def descend(rounds: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The first round's rows with their ``proof`` and their tree's ``top``.

    ``above`` has ``tree, proof, top``: what follows each tree's own steps.
    """
    ways = above.select("tree", F.lit(0).cast("long").alias("idx"), "proof", "top")
    if len(rounds) == 1:
        return rounds[0].drop("n").join(ways.drop("idx"), "tree")
    for nodes in reversed(rounds[:-1]):
        blocks = _in_blocks(nodes, levels)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema if f.name != "n")
        asked = ways.select("tree", F.col("idx").alias("block"), "proof", "top")
        ways = blocks.groupBy("tree", "block").cogroup(asked.groupBy("tree", "block")).applyInArrow(tables.lean(_descend_block(levels)), f"{fields}, proof {PROOF}, top string")
    return ways


def placed(rows: DataFrame, group: str, *order: str) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``run``, the stretch of one partition and group; the stretches with ``first``, ``before`` and ``n``).

    A row's place in its group is ``at - first + before``; ``n`` is the size of the group.
    """
    ordered = tables.cut(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order))
    # Partitions of a checkpoint stay as they were written, so these numbers are stable.
    counted = ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("run", F.shiftright("at", 33))
    runs = counted.groupBy(group, "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    by = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(by.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted, tables.cut(runs.select(group, "run", "first", before.alias("before"), F.sum("rows").over(by).alias("n")))


def _small(rows: DataFrame) -> bool:
    return rows.count() <= BROADCAST_ROWS


def manifest(rows: DataFrame, leaf: str, group: str, key: str, levels: int = LEVELS) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``proof`` (siblings left and right of the way, level by level).

    ``leaf`` names the column of the leaves' digests; a block has ``levels`` levels.
    """
    own = [c for c in rows.columns if c.lower() not in {"subroot", "root", "proof"}]
    # One letter before the group's name sets it apart from null, which comes first.
    inner = rows.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("label"), F.col(key).alias("key"), F.col(leaf).alias("digest"))
    counted, runs = placed(inner, "label", "key", "digest")
    names, spots = placed(runs.select("label").distinct().withColumn("all", F.lit(0)), "all", "label")
    trees = names.join(F.broadcast(spots) if _small(spots) else spots, ["all", "run"]).select("label", (F.col("at") - F.col("first") + F.col("before")).alias("tree"), F.col("n").alias("trees"))
    trees = tables.cut(trees)
    runs = tables.cut(runs.join(F.broadcast(trees) if _small(trees) else trees, "label"))
    met = counted.join(F.broadcast(runs), ["label", "run"]) if _small(runs) else tables.skewed_join(counted, runs, ["label", "run"])
    leaves = tables.cut(met.select("row", "tree", (F.col("at") - F.col("first") + F.col("before")).alias("idx"), "n", "digest"))
    rounds = climb(leaves, levels)
    tops = tables.cut(rounds[-1].select("tree", "digest").join(trees, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("n"), "digest"))
    heights = climb(tops, levels)
    last = heights[-1].first()
    root = last["digest"] if last else ""
    summit = rows.sparkSession.createDataFrame([(0, [], root)], f"tree long, proof {PROOF}, top string")
    above = tables.cut(descend(heights, summit, levels).select(F.col("idx").alias("tree"), "proof", F.col("digest").alias("top")))
    proven = descend(rounds, above, levels)
    return proven.select(*(F.col(f"row.`{c}`") for c in own), F.col("top").alias("subroot"), F.lit(root).alias("root"), "proof")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that a tampered text gives."""
    docs = tables.documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    meddled = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = tables.cut(docs.select("doc_id", "source", row_digest(*fields, F.col("text")).alias("leaf"), row_digest(*fields, meddled).alias("shown")))
    proven = manifest(leaves, "leaf", "source", "doc_id").select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), fold(F.col("shown"), F.col("proof")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(name: str) -> str:
    said = f"cast({name} AS varchar)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({said}) || ':' || {said} END"


def _sql() -> str:
    fields = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
    crc = "list_reduce(list_prepend(4294967295, list_transform(range(length(cast(doc_id AS varchar))), lambda i: ascii(substr(cast(doc_id AS varchar), i + 1, 1)))), lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, b: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))"
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, source, lang, n_chars, text, CASE WHEN {crc} & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS meddled FROM documents),
d AS (SELECT doc_id, coalesce('=' || source, '') AS label, sha256({fields} || {_field("text")}) AS leaf, sha256({fields} || {_field("meddled")}) AS shown FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY label) AS n, row_number() OVER () AS k FROM d),
nodes(label, level, idx, n, digest) AS (
  SELECT label, 0, idx, n, leaf FROM p
  UNION ALL SELECT label, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY label, level, idx // 3, n),
tops(level, idx, n, digest) AS (
  SELECT 0, row_number() OVER (ORDER BY label) - 1, count(*) OVER (), digest FROM nodes WHERE n = 1
  UNION ALL SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 3, n),
sub AS (SELECT label, digest AS subroot, row_number() OVER (ORDER BY label) - 1 AS place FROM nodes WHERE n = 1),
steps AS (
  SELECT k, a.level, coalesce(string_agg(a.digest, '' ORDER BY a.idx) FILTER (WHERE a.idx < p.idx // cast(3 ** a.level AS bigint)), '') AS l, coalesce(string_agg(a.digest, '' ORDER BY a.idx) FILTER (WHERE a.idx > p.idx // cast(3 ** a.level AS bigint)), '') AS r
  FROM p JOIN nodes a ON a.label = p.label AND a.n > 1 AND a.idx // 3 = p.idx // cast(3 ** (a.level + 1) AS bigint) GROUP BY k, a.level
  UNION ALL SELECT k, 1000 + a.level, coalesce(string_agg(a.digest, '' ORDER BY a.idx) FILTER (WHERE a.idx < s.place // cast(3 ** a.level AS bigint)), ''), coalesce(string_agg(a.digest, '' ORDER BY a.idx) FILTER (WHERE a.idx > s.place // cast(3 ** a.level AS bigint)), '')
  FROM p JOIN sub s USING (label) JOIN tops a ON a.n > 1 AND a.idx // 3 = s.place // cast(3 ** (a.level + 1) AS bigint) GROUP BY k, a.level),
proofs AS (SELECT k, string_agg(l || r, '' ORDER BY level) AS proof, list(l || '|' || r ORDER BY level) AS ways FROM steps GROUP BY k),
f AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(shown, coalesce(ways, [])), lambda own, x: sha256(split_part(x, '|', 1) || own || split_part(x, '|', 2))) AS folded_root
  FROM p JOIN sub USING (label) LEFT JOIN proofs USING (k))
SELECT *, folded_root = root AS verified FROM f"""


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLE_SQL = {"op11_merkle_manifest": _sql()}
