"""Dormant measures of contacts, stances and significance."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.operators import phases as P
from stridelake.operators.ranges import by_seq, with_runs
from stridelake.plans.register import S, T, query, samples, steps

RUN = S + """, c AS (SELECT *, CASE WHEN ({flag}) = lag({flag}) OVER w THEN 0 ELSE 1 END AS ch, ({flag}) AS f FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY session_id ORDER BY seq) AS run, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM c)"""


@query(RUN.format(flag="phase NOT IN (0, 1)") + ", k AS (SELECT *, count(*) OVER (PARTITION BY session_id, run) AS size FROM r) SELECT session_id, seq, CASE WHEN f THEN size / 1000.0 END AS contact FROM k")
def contact_duration(spark, sf_dir):
    """length of the contact that a sample lies in, in thousands."""
    runs = with_runs(samples(spark, sf_dir), ~F.col("phase").isin(0, 1))
    size = F.count("*").over(Window.partitionBy("session_id", "_run"))
    return runs.select("session_id", "seq", F.when(F.col("_flag"), size / 1000.0).alias("contact"))


@query(RUN.format(flag="phase = 0") + """, p AS (SELECT *, min(seq) OVER (PARTITION BY session_id, run) AS a FROM r WHERE f),
m AS (SELECT session_id, a + 5 * ((seq - a) // 5) AS start, quantile_cont(signal, 0.975) - quantile_cont(signal, 0.025) AS x FROM p GROUP BY session_id, a + 5 * ((seq - a) // 5), run)
SELECT session_id, start, round(CASE WHEN x < 30 THEN 0 ELSE x END, 5) AS spread FROM m""")
def balance_force(spark, sf_dir):
    """spread of force in pieces of a balance run; small ones are 0."""
    runs = with_runs(samples(spark, sf_dir), F.col("phase") == 0).where("_flag")
    first = F.min("seq").over(Window.partitionBy("session_id", "_run"))
    cut = runs.withColumn("start", first + 5 * F.floor((F.col("seq") - first) / 5))
    m = cut.groupBy("session_id", "_run", "start").agg((F.percentile("signal", F.lit(0.975)) - F.percentile("signal", F.lit(0.025))).alias("x"))
    return m.select("session_id", "start", F.round(F.when(F.col("x") < 30, 0.0).otherwise(F.col("x")), 5).alias("spread"))


@query(S + """, k AS (SELECT *, CASE WHEN signal > 0 AND signal <= 2 THEN 0 WHEN signal <= 4 THEN 1 WHEN signal <= 8 THEN 2 WHEN signal <= 20 THEN 3 ELSE 4 END AS bin, avg(signal) OVER (PARTITION BY session_id) AS m FROM s)
SELECT session_id, bin, count(*) AS n, round(avg((1 - least(abs(signal - m) / m, 1)) * (1 - least(abs(signal - m) / m, 1))), 6) AS score, round(sum(signal * (1 - least(abs(signal - m) / m, 1))), 4) AS destructive FROM k GROUP BY session_id, bin""")
def combined_scores(spark, sf_dir):
    """scores by bin, weighted by force."""
    x = F.col("signal")
    b = F.when((x > 0) & (x <= 2), 0).when(x <= 4, 1).when(x <= 8, 2).when(x <= 20, 3).otherwise(4)
    m = F.avg("signal").over(Window.partitionBy("session_id"))
    k = samples(spark, sf_dir).select("session_id", "signal", b.alias("bin"), (1 - F.least(F.abs(x - m) / m, F.lit(1.0))).alias("c"))
    return k.groupBy("session_id", "bin").agg(F.count("*").alias("n"), F.round(F.avg(F.col("c") * F.col("c")), 6).alias("score"), F.round(F.sum(x * F.col("c")), 4).alias("destructive"))


@query(S + """, x AS (SELECT *, abs(signal) * 0.3 AS lat, abs(signal) * 0.6 AS ver, abs(signal - 50) * 0.2 AS hor FROM s), y AS (SELECT *, lat + ver + hor AS t FROM x)
SELECT session_id, seq, CAST(t > 0 AND lat / t > 0.2 AS INTEGER) AS lateral, CAST(t > 0 AND ver / t > 0.75 AS INTEGER) AS vertical, CAST(t > 0 AND hor / t > 0.2 AS INTEGER) AS horizontal FROM y""")
def movement_planes(spark, sf_dir):
    """planes that dominate a movement."""
    x = F.col("signal")
    out = P.movement_planes(samples(spark, sf_dir), F.abs(x) * 0.3, F.abs(x) * 0.6, F.abs(x - 50) * 0.2, F.lit(0.0))
    return out.select("session_id", "seq", "lateral", "vertical", "horizontal")


def _stance_sql() -> str:
    """The rule by windows, one numbering of runs after the other (half a second is 10 samples, the pad none)."""
    w = "(PARTITION BY session_id ORDER BY seq)"
    out = S + ", v0 AS (SELECT session_id, seq, phase AS l, event_id * 7 % 4 AS r, signal / 20 > 2.5 AS hot, max(seq) OVER (PARTITION BY session_id) + 1 AS n FROM s)"
    last = 0

    def numbered(flag: str) -> str:
        nonlocal out, last
        out += f", a{last} AS (SELECT *, ({flag}) AS f, lag({flag}) OVER {w} AS g FROM v{last}), b{last} AS (SELECT * EXCLUDE (g), sum(CASE WHEN f = g THEN 0 ELSE 1 END) OVER {w} AS run FROM a{last})"
        last += 1
        return f"b{last - 1}"

    for name, flag in (("lb", "l = 0 AND r <> 0"), ("rb", "r = 0 AND l <> 0"), ("db", "l = 0 AND r = 0")):
        source = numbered(flag)
        out += f", v{last} AS (SELECT * EXCLUDE (f, run), CASE WHEN f AND count(*) OVER (PARTITION BY session_id, run) > 10 AND NOT hot THEN 1 ELSE 0 END AS {name} FROM {source})"
    for name in ("lb", "rb", "db"):
        source = numbered(f"{name} = 0")
        out += f", c{last} AS (SELECT *, max(seq) OVER u + 1 - CASE WHEN max(seq) OVER u + 1 = n THEN 1 ELSE 0 END AS stop, min(seq) OVER u AS start FROM {source} WINDOW u AS (PARTITION BY session_id, run))"
        out += f", v{last} AS (SELECT * EXCLUDE (f, run, stop, start, {name}), CASE WHEN f AND seq < stop AND stop - start < 10 THEN 1 ELSE {name} END AS {name} FROM c{last})"
    for name, phase in (("di", 2), ("dt", 3)):
        for own, other in (("l", "r"), ("r", "l")):
            source = numbered(f"{own} = {phase}")
            out += f", v{last} AS (SELECT * EXCLUDE (f, run), f AND bool_or({other} = {phase}) OVER (PARTITION BY session_id, run) AS {name}{own} FROM {source})"
    return out + f""" SELECT session_id, seq, CASE WHEN l = 1 AND r = 1 THEN 1 WHEN dil OR dir OR dtl OR dtr THEN 3 WHEN l IN (2, 3) OR r IN (2, 3) THEN 2 WHEN db = 1 THEN 5 WHEN l = 0 AND r = 0 THEN 3 WHEN lb = 1 OR rb = 1 THEN 4
WHEN (l = 0) <> (r = 0) THEN 2 ELSE 0 END AS stance FROM v{last}"""


@query(_stance_sql())
def stance_enumeration(spark, sf_dir):
    """stances from the phases of both feet."""
    s = samples(spark, sf_dir).select("session_id", "seq", "phase", "signal", ((F.col("event_id") * 7) % 4).cast("int").alias("phase_rf"))
    return P.stance(s, "phase", "phase_rf", F.lit(False), F.col("signal") / 20, 20).select("session_id", "seq", "stance")


def t_two_sided(t: float, free: int) -> float:
    """Two-sided p of Student's t, by the density's integral (Simpson's rule on a bounded substitution)."""
    if free <= 0 or not np.isfinite(t):
        return 1.0 if free <= 0 else 0.0
    # t = sqrt(free) tan(a): the density becomes proportional to cos(a)^(free - 1).
    a = np.linspace(0, math.atan(abs(t) / math.sqrt(free)), 2001)
    y = np.cos(a) ** (free - 1)
    inside = (a[1] - a[0]) / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())
    whole = math.sqrt(math.pi) * math.exp(math.lgamma(free / 2) - math.lgamma((free + 1) / 2))
    return max(0.0, 1 - 2 * inside / whole)


#: The p-value in SQL: Simpson's rule over 2,000 steps for every correlation.
_PEARSON = T + """, g AS (SELECT side, status, step, corr(force, accel) AS r, count(*) AS n FROM t WHERE side IS NOT NULL GROUP BY side, status, step),
h AS (SELECT *, n - 2 AS free, atan(abs(r) / sqrt(greatest(1 - r * r, 1e-300))) AS top FROM g WHERE n > 2 AND r IS NOT NULL AND NOT isnan(r)),
y AS (SELECT side, status, step, free, top, sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(cos(top * i / 2000), free - 1)) * top / 6000 AS inside FROM h, range(2001) u(i) GROUP BY side, status, step, free, top),
p AS (SELECT side, status, step, 1 - 2 * inside / (sqrt(pi()) * exp(lgamma(free / 2.0) - lgamma((free + 1) / 2.0))) AS p FROM y)
SELECT side, status, step, CASE WHEN r IS NULL OR isnan(r) THEN 0 WHEN p <= 0.05 THEN round(r, 9) END AS r FROM g LEFT JOIN p USING (side, status, step)"""


@query(_PEARSON)
def significant_pearson(spark, sf_dir):
    """Correlation where it is significant, null where not, 0 where there is none."""

    @F.pandas_udf("double")
    def least_r(n: pd.Series) -> pd.Series:
        """The least significant |r| of n pairs, by bisection of the t test."""
        out = []
        for k in n:
            lo, hi = 0.0, 1.0
            for _ in range(60 if k > 2 else 0):
                mid = (lo + hi) / 2
                lo, hi = (lo, mid) if t_two_sided(mid * math.sqrt((k - 2) / max(1 - mid * mid, 1e-300)), int(k) - 2) <= 0.05 else (mid, hi)
            out.append(hi if k > 2 else 2.0)
        return pd.Series(out)

    g = steps(spark, sf_dir).where("side IS NOT NULL").groupBy("side", "status", "step").agg(F.corr("force", "accel").alias("r"), F.count("*").alias("n"))
    # The test depends on the number of pairs only: once a distinct number.
    bound = g.select("n").distinct().withColumn("least", least_r("n"))
    return g.join(bound, "n").select("side", "status", "step", F.when(F.col("r").isNull() | F.isnan("r"), 0.0).when(F.abs("r") >= F.col("least"), F.round("r", 9)).alias("r"))


@query(T + """, k AS (SELECT block_id, count(*) AS n, sum(force) AS total, avg(force) AS mean, max(accel) AS peak, quantile_cont(accel, 0.5) AS median, quantile_cont(accel, 0.95) AS p95, bool_or(discount > 0.09) AS removed FROM t GROUP BY block_id)
SELECT block_id, n * 10 AS duration_ms, total, mean, CASE WHEN NOT removed THEN peak END AS peak, CASE WHEN NOT removed THEN median END AS median, CASE WHEN NOT removed THEN round(p95, 6) END AS p95 FROM k""")
def step_records(spark, sf_dir):
    """Step records; a flagged sample leaves the measures null."""
    k = steps(spark, sf_dir).groupBy("block_id").agg(F.count("*").alias("n"), F.sum("force").alias("total"), F.avg("force").alias("mean"), F.max("accel").alias("peak"), F.median("accel").alias("median"), F.round(F.percentile("accel", F.lit(0.95)), 6).alias("p95"), F.bool_or(F.col("discount") > 0.09).alias("removed"))
    kept = lambda c: F.when(~F.col("removed"), F.col(c)).alias(c)
    return k.select("block_id", (F.col("n") * 10).alias("duration_ms"), "total", "mean", kept("peak"), kept("median"), kept("p95"))


@query(RUN.format(flag="phase = 2") + """, g AS (SELECT session_id, run, min(seq) AS start, arg_max(seq, signal * 100000 - seq) AS top, max(signal) AS high, arg_min(signal, seq) AS low FROM r WHERE f GROUP BY session_id, run)
SELECT session_id, start, round(CASE WHEN top > start AND high > low THEN (high - low) / ((top - start) / 100.0) ELSE 0 END, 4) AS rate FROM g""")
def force_absorption_rate(spark, sf_dir):
    """Slope from the first sample of an impact to its peak (the whole rule is ``force_absorption``)."""
    runs = with_runs(samples(spark, sf_dir), F.col("phase") == 2).where("_flag")
    g = runs.groupBy("session_id", "_run").agg(F.min("seq").alias("start"), F.max_by("seq", F.struct("signal", -F.col("seq"))).alias("top"), F.max("signal").alias("high"), F.min_by("signal", "seq").alias("low"))
    rises = (F.col("top") > F.col("start")) & (F.col("high") > F.col("low"))
    return g.select("session_id", "start", F.round(F.when(rises, (F.col("high") - F.col("low")) / ((F.col("top") - F.col("start")) / 100.0)).otherwise(0.0), 4).alias("rate"))


@query(S + """, l AS (SELECT *, lag(signal) OVER w AS p1, lag(signal, 2) OVER w AS p2, coalesce(lag(phase) OVER w, -1) AS before FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq))
SELECT session_id, seq, CASE WHEN signal - p1 > 20 THEN 'rearfoot' WHEN signal - p1 < -20 THEN 'forefoot' ELSE 'midfoot' END AS landing FROM l WHERE phase = 2 AND before <> 2 AND p1 IS NOT NULL""")
def landing_pattern(spark, sf_dir):
    """Sign of the change of pitch at first contact (the whole rule is ``landings``)."""
    w = by_seq()
    s = samples(spark, sf_dir).select("*", F.lag("signal").over(w).alias("p1"), F.coalesce(F.lag("phase").over(w), F.lit(-1)).alias("before")).where("phase = 2 AND before <> 2 AND p1 IS NOT NULL")
    d = F.col("signal") - F.col("p1")
    return s.select("session_id", "seq", F.when(d > 20, "rearfoot").when(d < -20, "forefoot").otherwise("midfoot").alias("landing"))


@query("""WITH l AS (SELECT c_custkey, c_nationkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) AS k FROM customer) SELECT c_nationkey AS label, count(*) AS n, round(100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*), 6) AS perc_correct FROM l GROUP BY c_nationkey""")
def placement_accuracy(spark, sf_dir):
    """Share of positive balances by nation (answers by code are ``accuracy_by_code``)."""
    from stridelake.plans.register import table

    c = table(spark, sf_dir, "customer")
    return c.groupBy(F.col("c_nationkey").alias("label")).agg(F.count("*").alias("n"), F.round(100.0 * F.count_if(F.col("c_acctbal") > 0) / F.count("*"), 6).alias("perc_correct"))


@query(S + """, b AS (SELECT event_type AS condition, CAST(least(floor(signal / 25), 19) AS INTEGER) AS bin FROM s WHERE seq < 1000)
SELECT condition, bin, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY condition), 6) AS pct FROM b GROUP BY condition, bin""")
def placement_model(spark, sf_dir):
    """Histogram of the first samples by type (training by condition is ``trained_placement``)."""
    b = samples(spark, sf_dir).where("seq < 1000").groupBy(F.col("event_type").alias("condition"), F.least(F.floor(F.col("signal") / 25), F.lit(19)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return b.select("condition", "bin", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("condition")), 6).alias("pct"))
