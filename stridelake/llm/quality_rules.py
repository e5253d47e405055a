"""Line-first quality rules (DataFrame functions only).

Each line is judged on its own by three rules; failing lines are removed, and a document
that loses more than half of its characters that way is rejected.  The rules:

* punctuation: symbol characters make up more than 5 % of the line, or doubled exclamation
  marks more than 10 %;
* navigation: at most three words and no closing punctuation, in a text of several lines;
* boilerplate: the line holds a licence, consent or sign-up phrase.

A line without words always stays.  Everything is computed inside one row, so the plan has
no shuffle and a hot source or a very long document costs no more than its own bytes.

Edge cases: a null text counts as empty, gets zero counts, fails the base rule (fewer than
50 words) and keeps an empty clean text.  Repeated rows are judged alike.  An empty table
gives an empty result.  Input columns other than the two named ones pass through untouched;
result columns replace input columns of the same name.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import tables

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: At most three words, the last one of letters and digits only.
BARE = r"^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){0,2}[\p{L}\p{N}]+[\x20\x09-\x0D]*\z"
#: Phrases of boilerplate, in lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "accept cookies", "sign up for", "subscribe to our", "click here to", "enable javascript", "skip to content",
)
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOST_PERCENT = 50, 50, 50


def _fails(line: Column, alone: Column) -> Column:
    size = F.length(line)
    symbols = size - F.length(F.regexp_replace(line, SYMBOLS, ""))
    bangs = size - F.length(F.replace(line, F.lit("!!"), F.lit("")))
    punctuation = (symbols * 20 > size) | (bangs * 10 > size)
    navigation = ~alone & (size < 60) & line.rlike(BARE)
    low = F.lower(line)
    return line.rlike(WORD) & (punctuation | navigation | reduce(or_, (F.contains(low, F.lit(p)) for p in BOILERPLATE)))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text."""
    n = F.size(words)
    return F.when(
        n > 3, F.sort_array(F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(1))), lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))



def clean_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with counts, the base verdict, the method's verdict and the cleaned text.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long),
    ``base_failed``, ``kept``, ``n_lines_removed``, ``n_chars_removed`` and ``clean_text``.
    """
    own = [c for c in df.columns if c.lower() not in {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "n_chars_removed", "clean_text"}]
    whole = F.coalesce(F.col(text), F.lit(""))
    # The row goes along as one column, so that no name of it can meet a helper's.
    split = df.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), whole.alias("_t"), F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("_w"), F.split(whole, "\n", -1).alias("_l"))
    sorted_windows = split.withColumn("_s", _repeat_words(F.col("_w")))
    # Equal windows are neighbours after the sort; their places, sorted, tell how many words they cover.
    s = F.col("_s")
    twice = sorted_windows.withColumn("_p", F.sort_array(F.transform(F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"]))), lambda x: x["p"])))
    twice = twice.drop("_s")
    p = F.col("_p")
    gaps = F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))), F.lit(0).cast("long"), lambda total, x: total + x)
    worded = F.filter(F.col("_l"), lambda line: line.rlike(WORD))
    counted = twice.select(
        "row", "_t", "_l",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
        gaps.alias("n_repeat_words"),
        F.filter(F.col("_l"), lambda line: ~_fails(line, F.size("_l") == 1)).alias("_good"),
    )
    judged = counted.select(
        "row", "_t", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)).alias("base_failed"),
        (F.size("_l") - F.size("_good")).cast("long").alias("n_lines_removed"),
        F.array_join("_good", "\n").alias("clean_text"),
    )
    lost = judged.withColumn("n_chars_removed", (F.length("_t") - F.length("clean_text")).cast("long"))
    kept = ~F.col("base_failed") & (F.col("n_chars_removed") * 100 <= F.length("_t") * MAX_LOST_PERCENT)
    return lost.select(*(F.col(f"row.`{c}`") for c in own), *(c for c in lost.columns if c not in {"row", "_t"}), kept.alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document."""
    return clean_lines(tables.documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "n_chars_removed")


def _sql() -> str:
    phrases = " OR ".join(f"contains(lower(x), '{p}')" for p in BOILERPLATE)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM dup, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY doc_id),
c AS (
  SELECT d.doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
    len(list_filter(l, lambda x: regexp_matches(x, '{WORD}'))) - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '{WORD}')))) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines,
    list_filter(l, lambda x: NOT (regexp_matches(x, '{WORD}') AND (
      (length(x) - length(regexp_replace(x, '{SYMBOLS}', '', 'g'))) * 20 > length(x)
      OR (length(x) - length(replace(x, '!!', ''))) * 10 > length(x)
      OR (len(l) > 1 AND length(x) < 60 AND regexp_matches(x, '{BARE}'))
      OR {phrases}))) AS good
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed,
    length(t) - length(coalesce(array_to_string(good, chr(10)), '')) AS n_chars_removed FROM c)
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(word_chars AS bigint) AS word_chars, cast(n_symbols AS bigint) AS n_symbols,
  cast(n_dup_lines AS bigint) AS n_dup_lines, cast(n_repeat_words AS bigint) AS n_repeat_words, base_failed,
  NOT base_failed AND n_chars_removed * 100 <= length(t) * {MAX_LOST_PERCENT} AS kept,
  cast(n_lines - len(good) AS bigint) AS n_lines_removed, cast(n_chars_removed AS bigint) AS n_chars_removed
FROM f"""


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLE_SQL = {"op2_quality_rules": _sql()}
