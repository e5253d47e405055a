"""URL filters: rules of a host and a path prefix, found by hashed expressions.

Each URL is expanded into expressions, one for each suffix of its host at a dot and each
prefix of its path.  An expression meets the rules in an equi-join on the first eight hex
digits of its SHA-256; the full digests then confirm the match, and of all rules that fit
the longest one decides.

A prefix may end anywhere in the path (``/en/1`` fits ``/en/12``), so only those lengths of
suffix and prefix are expanded that some rule has; their distinct lengths are all that the
driver sees of the rules (at most the length of the longest rule).  The rules are broadcast
while they are small (both counts are checked) and are shuffled beyond that.

Work is done once for each distinct (host, path); the verdicts then meet the URLs in a join
that adaptive execution splits where one URL is hot.

Edge cases: a null URL, or one without ``://``, has an empty host and path and fits no rule
with a host.  Repeated rows and null keys keep their rows.  Rules with a null part never
fit.  Of equally long rules the one with the longer host decides, then ``block``.  An empty
table gives an empty result; without rules every URL gets the default verdict.  Other input
columns pass untouched, whatever their names; result columns replace input columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import tables

RULES = "host string, path string, verdict string"
ALLOW, BLOCK = "allow", "block"
#: Hex digits of the short prefix that is joined on.
SHORT = 8
#: Rules are broadcast up to so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the registered query.
QUERY_RULES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def expressions(sites: DataFrame, host_lengths: list[int], path_lengths: list[int]) -> DataFrame:
    """``host, path, short, full`` for each host suffix and path prefix of the given lengths."""
    host, path = F.col("host"), F.col("path")
    size = F.length(host)

    def lengths(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<int>")

    suffixes = F.filter(lengths(host_lengths), lambda n: (n == size) | ((n < size) & (F.substr(host, size - n, F.lit(1)) == ".")))
    prefixes = F.filter(lengths(path_lengths), lambda n: n <= F.length(path))
    said = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.right(host, s), F.left(path, p)))))
    hashed = sites.select("host", "path", F.explode(said).alias("said")).select("host", "path", F.sha2("said", 256).alias("full"))
    return hashed.withColumn("short", F.left("full", F.lit(SHORT)))


def best_rules(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict``: the deciding rule of those distinct (host, path) that any rule fits."""
    rules = rules.select("host", "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    shape = rules.agg(F.collect_set(F.length("host")).alias("hosts"), F.collect_set(F.length("path")).alias("paths"), F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("host") + F.octet_length("path")).alias("bytes")).first()
    rule = F.concat("host", "path")
    rank = F.struct(F.length(rule).alias("size"), F.length("host").alias("host_size"), (F.col("verdict") == BLOCK).alias("blocks"), rule.alias("rule"), "verdict")
    hashed = rules.select(F.sha2(rule, 256).alias("rule_full"), rank.alias("found")).withColumn("short", F.left("rule_full", F.lit(SHORT)))
    asked = expressions(sites, sorted(shape["hosts"]), sorted(shape["paths"]))
    if shape["rows"] <= BROADCAST_ROWS and (shape["bytes"] or 0) <= BROADCAST_BYTES:
        met = asked.join(F.broadcast(hashed), "short")
    else:
        met = tables.skewed_join(asked, hashed, ["short"])
    best = met.where("full = rule_full").groupBy("host", "path").agg(F.max("found").alias("found"))
    return best.select("host", "path", "found.rule", "found.verdict")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    own = [c for c in urls.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    parts = urls.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row") if own else F.struct(F.lit(0)).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    best = tables.cut(best_rules(parts.select("host", "path").distinct(), rules))
    found = tables.skewed_join(parts, best, ["host", "path"], "left")
    return found.select(*(F.col(f"row.`{c}`") for c in own), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, spark.createDataFrame(QUERY_RULES, RULES)).drop("url")


def _sql() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in QUERY_RULES)
    return rf"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {values}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages),
p AS (SELECT page_id, translate(regexp_extract(u, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS k FROM rest),
m AS (SELECT k, rule_host || rule_path AS rule, rule_verdict FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
b AS (SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS verdict FROM m GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, '{ALLOW}') AS verdict FROM p LEFT JOIN b USING (k)"""


QUERIES = {"op12_url_filters": op12_url_filters}
ORACLE_SQL = {"op12_url_filters": _sql()}
