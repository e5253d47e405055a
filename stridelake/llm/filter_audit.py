"""Audit of filter interactions: what each filter removes in every order of the filters.

Each document has a mask of the filters that it fails.  In an order of the filters it is
removed by the first one in its mask.  Orders are numbered by their Lehmer rank, so all
orders that begin alike are one interval of ranks, and at each step a mask is removed,
kept or failed again on a few such intervals.  The counts of each mask are added where its
intervals begin and taken off where they end; a prefix sum over the ranks then gives the
totals of every order without visiting a document twice.

Documents meet three times, in small rows of a digest, an id and a mask: with their labels,
with the least id of their text, and as counts by (part, mask).  Joins are split by adaptive
execution where an id or a text is hot; all else has at most 32 masks a part.

Edge cases: a null text counts as empty and equals every empty text; a null part is the
empty string.  A document with a null id has no label and is no copy; equal ids are not
smaller than each other.  Repeated rows count each.  With several label rows an id is good
(or toxic) if any of them says so.  An empty table gives an empty result.  Other input
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import permutations
from math import factorial
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm import tables

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 100, 80, 10
WORD, CAPITAL, SYMBOL = r"[^\x20\x09-\x0D]+", "[A-Z]", r"[#$%&*|]"
KINDS = ("kept", "removed", "redundant", "unique_fails")
COUNTS = (*KINDS, "good_lost", "toxic_lost")


def lehmer_rank(prefix: tuple[int, ...], size: int) -> int:
    """Rank of the first of ``size`` numbers' permutations that begins with ``prefix``, in lexicographic order."""
    return sum(sum(other < now and other not in prefix[:i] for other in range(size)) * factorial(size - 1 - i) for i, now in enumerate(prefix))


def difference_entries(size: int = len(FILTERS)) -> list[tuple[int, ...]]:
    """(mask, step, rank, changes of the four kinds): ends of the intervals of ranks, summed where they meet."""
    ends: dict[tuple[int, int, int], list[int]] = defaultdict(lambda: [0] * len(KINDS))
    for step in range(1, size + 1):
        for prefix in permutations(range(size), step):
            begin, own, before = lehmer_rank(prefix, size), 1 << prefix[-1], sum(1 << f for f in prefix[:-1])
            for mask in range(1 << size):
                fails, gone = bool(mask & own), bool(mask & before)
                for kind, holds in enumerate((not fails and not gone, fails and not gone, fails and gone, mask == own)):
                    ends[mask, step, begin][kind] += holds
                    ends[mask, step, begin + factorial(size - step)][kind] -= holds
    return [(*at, *changes) for at, changes in sorted(ends.items()) if any(changes) and at[2] < factorial(size)]


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, CAPITAL, ""))
    fails = (n < MIN_WORDS, distinct * 100 < n * MIN_DISTINCT_PERCENT, capitals * 100 > F.length(text) * MAX_CAPITAL_PERCENT, text.rlike(SYMBOL))
    return reduce(add, (F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)))


def masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part by the filters that they fail."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = tables.cut(docs.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.unhex(F.sha2(whole, 256)).alias("digest"), text_mask(F.col(text)).alias("mask")))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    first = tables.cut(rows.groupBy("digest").agg(F.min("id").alias("first")))
    known = tables.skewed_join(tables.skewed_join(rows, first, ["digest"]), tables.cut(marks), ["id"], "left")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * (1 << FILTERS.index("E"))
    return known.groupBy("part", (F.col("mask") + copy).alias("mask")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("good", F.lit(False))).alias("good"), F.count_if(F.coalesce("toxic", F.lit(False))).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """One row a part, order and step from the counts of :func:`masks`."""
    spark, size = counts.sparkSession, len(FILTERS)
    counts = tables.cut(counts)
    # At most 32 masks x 5 steps x 120 ranks, whatever the input.
    entries = spark.createDataFrame(difference_entries(size), "mask int, step int, rank int, " + ", ".join(f"d_{k} int" for k in KINDS))
    weights = [("n", k) for k in KINDS] + [("good", "removed"), ("toxic", "removed")]
    changes = counts.join(F.broadcast(entries), "mask").select("part", "step", "rank", *((F.col(w) * F.col(f"d_{k}")).alias(c) for c, (w, k) in zip(COUNTS, weights)))
    places = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step")).select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(size) - 1))).alias("rank"))
    zeros = places.select("part", "step", "rank", *(F.lit(0).cast("long").alias(c) for c in COUNTS))
    summed = changes.unionByName(zeros).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in COUNTS))
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    totals = summed.select("part", "step", "rank", *(F.sum(c).over(along).alias(c) for c in COUNTS))
    orders = spark.createDataFrame([(rank, "".join(order)) for rank, order in enumerate(permutations(FILTERS))], "rank int, filter_order string")
    named = totals.join(F.broadcast(orders), "rank").withColumn("filter", F.substr("filter_order", F.col("step"), F.lit(1)))
    return named.select("part", "filter_order", "step", *COUNTS, F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters in all 120 orders, by language, over all documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(masks(tables.documents(spark, sf_dir, "doc_id", "lang", "text"), labels))


_SQL = rf"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
c AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < {MIN_WORDS} THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '{CAPITAL}', '', 'g'))) > {MAX_CAPITAL_PERCENT} * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '{SYMBOL}') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM c GROUP BY part, fails),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, cast(step AS integer) AS step, filter_order[step] AS own, left(filter_order, step - 1) AS before FROM o, unnest(range(1, 6)) AS u(step)),
t AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN translate(fails, before || own, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, own) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, cast(kept AS bigint) AS kept, cast(removed AS bigint) AS removed, cast(redundant AS bigint) AS redundant, cast(unique_fails AS bigint) AS unique_fails,
  cast(good_lost AS bigint) AS good_lost, cast(toxic_lost AS bigint) AS toxic_lost, cast(sum(removed) OVER (PARTITION BY part, own) AS bigint) AS shapley
FROM t"""

QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE_SQL = {"op13_filter_audit": _SQL}
