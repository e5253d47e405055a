"""Aggregations, statistics, bands and reports over the steps and samples views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.operators import statistics as H
from stridelake.operators.ranges import by_seq
from stridelake.plans.register import S, T, query, samples, steps, table

TWO = "WHERE side IS NOT NULL"


def _by_side(c, s):
    return F.when(F.col("side") == s, F.col(c))


@query(T + """, a AS (SELECT block_id, (max(at_us) - min(at_us)) / 1e6 AS duration, sum(force) AS total, avg(force) AS mean, sum(CASE WHEN side = 'LF' THEN force END) AS lf, sum(CASE WHEN side = 'RF' THEN force END) AS rf FROM t GROUP BY block_id)
SELECT block_id, duration, total, mean, lf, rf, CASE WHEN lf > 0 AND rf > 0 THEN lf / (lf + rf) * 100 END AS perc_left, CASE WHEN lf > 0 AND rf > 0 THEN rf / (lf + rf) * 100 END AS perc_right, CASE WHEN lf > 0 AND rf > 0 THEN abs(lf - rf) / (lf + rf) * 100 END AS perc_diff FROM a""")
def block_aggregate(spark, sf_dir):
    """A1: duration, sums and shares of a block; no shares unless both sides have force."""
    a = steps(spark, sf_dir).groupBy("block_id").agg(((F.max("at_us") - F.min("at_us")) / 1e6).alias("duration"), F.sum("force").alias("total"), F.avg("force").alias("mean"), F.sum(_by_side("force", "LF")).alias("lf"), F.sum(_by_side("force", "RF")).alias("rf"))
    both, whole = (F.col("lf") > 0) & (F.col("rf") > 0), F.col("lf") + F.col("rf")
    share = lambda c, n: F.when(both, c / whole * 100).alias(n)
    return a.select("*", share(F.col("lf"), "perc_left"), share(F.col("rf"), "perc_right"), share(F.abs(F.col("lf") - F.col("rf")), "perc_diff"))


def _stats_sql(name: str, value: str, qs) -> str:
    out = []
    for s in ("LF", "RF"):
        own, n = f"CASE WHEN side = '{s}' THEN {value} END", f"count(CASE WHEN side = '{s}' THEN {value} END)"
        both = f"count(CASE WHEN side = 'LF' THEN {value} END) > 0 AND count(CASE WHEN side = 'RF' THEN {value} END) > 0"
        out += [f"round(CASE WHEN {both} THEN avg({own}) END, 6) AS {name}_{s.lower()}", f"round(CASE WHEN {both} AND {n} >= 5 THEN stddev_pop({own}) END, 6) AS {name}_{s.lower()}_std"]
        for q in qs:
            few = f"min({own})" if q < 50 else f"max({own})" if q > 50 else f"quantile_cont({own}, 0.5)"
            out.append(f"round(CASE WHEN {both} THEN CASE WHEN {n} >= 5 THEN quantile_cont({own}, {q / 100}) ELSE {few} END END, 6) AS {name}_{s.lower()}_{q}")
    return ", ".join(out)


@query(T + ", u AS (SELECT *, CAST(floor(block_id / 10) AS BIGINT) AS block FROM t) SELECT block, " + _stats_sql("force", "force", (5, 50, 95)) + " FROM u GROUP BY block")
def side_stats(spark, sf_dir):
    """A2: left and right distributions; the right 95 % quantile follows the same rule as the left."""
    t = steps(spark, sf_dir).withColumn("block", F.floor(F.col("block_id") / 10))
    cols = H.side_stats("force", "side", "force")
    names = [f"force_{s}{e}" for s in ("lf", "rf") for e in ("", "_std", "_5", "_50", "_95")]
    return t.groupBy("block").agg(*cols).select("block", *(F.round(n, 6).alias(n) for n in names))


@query(T + ", u AS (SELECT *, CAST(floor(block_id / 40) AS BIGINT) AS block FROM t) SELECT block, " + _stats_sql("peak", "accel", (5, 50, 75, 95, 99)) + ", max(CASE WHEN side = 'LF' THEN accel END) AS max_left, max(CASE WHEN side = 'RF' THEN accel END) AS max_right FROM u GROUP BY block")
def peak_stats(spark, sf_dir):
    """A3: as A2 with more quantiles and the maximum."""
    t = steps(spark, sf_dir).withColumn("block", F.floor(F.col("block_id") / 40))
    names = [f"peak_{s}{e}" for s in ("lf", "rf") for e in ("", "_std", "_5", "_50", "_75", "_95", "_99")]
    found = t.groupBy("block").agg(*H.side_stats("accel", "side", "peak", (5, 50, 75, 95, 99)), F.max(_by_side("accel", "LF")).alias("max_left"), F.max(_by_side("accel", "RF")).alias("max_right"))
    return found.select("block", *(F.round(n, 6).alias(n) for n in names), "max_left", "max_right")


PEAK = "coalesce(signal > lag(signal) OVER w AND signal >= lead(signal) OVER w AND signal >= 12, false)"


@query(S + f", k AS (SELECT *, {PEAK} AS peak FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq)) SELECT session_id, round(sum(signal), 6) AS total, round(avg(signal), 6) AS mean, CASE WHEN count(*) >= 2 THEN round(quantile_cont(signal, 0.95) * 10000, 2) ELSE 0.0 END AS peak95 FROM k WHERE peak GROUP BY session_id")
def peak_totals(spark, sf_dir):
    """A4, A5: totals and the 95 % quantile of peaks."""
    from stridelake.operators.windows import local_peaks

    k = samples(spark, sf_dir).withColumn("peak", local_peaks("signal", 12.0)).where("peak")
    p95 = F.when(F.count("*") >= 2, F.round(F.percentile("signal", F.lit(0.95)) * 10000, 2)).otherwise(0.0)
    return k.groupBy("session_id").agg(F.round(F.sum("signal"), 6).alias("total"), F.round(F.avg("signal"), 6).alias("mean"), p95.alias("peak95"))


@query(T + """, g AS (SELECT block_id, max(force) AS peak, count(*) AS n, max(force) - min_by(force, step * 1000000 + accel) AS rise, arg_max(step, force * 1000 - step) AS place FROM t GROUP BY block_id)
SELECT block_id, peak / n AS per_contact, CASE WHEN rise > 0.1 THEN rise / place END AS per_impact, CASE WHEN rise > 0.1 THEN rise / (CAST(place AS DOUBLE) / n) END AS per_share FROM g""")
def force_ratios(spark, sf_dir):
    """Peak and rise against contact and impact time; the highest peak counts, the first on ties."""
    g = steps(spark, sf_dir).groupBy("block_id").agg(F.max("force").alias("peak"), F.count("*").alias("n"), (F.max("force") - F.min_by("force", F.col("step") * 1000000 + F.col("accel"))).alias("rise"), F.max_by("step", F.struct("force", -F.col("step"))).alias("place"))
    rises = F.col("rise") > 0.1
    return g.select("block_id", (F.col("peak") / F.col("n")).alias("per_contact"), F.when(rises, F.col("rise") / F.col("place")).alias("per_impact"), F.when(rises, F.col("rise") / (F.col("place") / F.col("n"))).alias("per_share"))


@query(T + """SELECT block_id, sum(accel) AS total, least(sum(force * abs(accel)) / sum(abs(accel)), 100) AS weighted, least(100.0 * sum(CASE WHEN discount > 0.05 THEN accel ELSE 0 END) / sum(accel), 100) AS perc_optimal FROM t GROUP BY block_id""")
def weighted_control(spark, sf_dir):
    """Weighted mean with weights of acceleration, shares capped at 100."""
    w = F.abs("accel")
    return steps(spark, sf_dir).groupBy("block_id").agg(
        F.sum("accel").alias("total"), F.least(F.sum(F.col("force") * w) / F.sum(w), F.lit(100.0)).alias("weighted"), F.least(100.0 * F.sum(F.when(F.col("discount") > 0.05, F.col("accel")).otherwise(0.0)) / F.sum("accel"), F.lit(100.0)).alias("perc_optimal")
    )


BANDS = {"force": (10.0, 30.0), "accel": (20000.0, 60000.0)}


@query(T + """, v AS (SELECT 'force' AS variable, force AS x, accel AS w, 10.0 AS lo, 30.0 AS hi FROM t UNION ALL SELECT 'accel', accel, accel, 20000.0, 60000.0 FROM t),
b AS (SELECT variable, CASE WHEN x < lo THEN 'green' WHEN x < hi THEN 'yellow' ELSE 'red' END AS band, count(*) AS n, round(sum(w), 2) AS load FROM v GROUP BY ALL)
SELECT variable, band, n, load, round(100.0 * n / sum(n) OVER (PARTITION BY variable), 6) AS perc FROM b""")
def exposure_bands(spark, sf_dir):
    """A10: exposure in red, yellow and green bands of several variables."""
    t = steps(spark, sf_dir)
    long = t.select(F.explode(F.array(*(F.struct(F.lit(n).alias("variable"), F.col(n).alias("x"), F.col("accel").alias("w"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for n, (lo, hi) in BANDS.items()))).alias("v")).select("v.*")
    band = F.when(F.col("x") < F.col("lo"), "green").when(F.col("x") < F.col("hi"), "yellow").otherwise("red")
    b = long.groupBy("variable", band.alias("band")).agg(F.count("*").alias("n"), F.round(F.sum("w"), 2).alias("load"))
    return b.withColumn("perc", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("variable")), 6))


@query(T + """, g AS (SELECT CASE WHEN force < 15 THEN 'low' WHEN force < 35 THEN 'moderate' ELSE 'high' END AS intensity, CASE WHEN force <= 2 THEN CASE WHEN force < 2 THEN 'low' ELSE 'high' END WHEN force <= 3 THEN 'moderate' ELSE 'high' END AS force_band, status AS stance, side, accel FROM t)
SELECT intensity, force_band, stance, side, count(*) AS n, round(sum(accel), 2) AS total, round(avg(accel), 4) AS mean, round(100 * sum(accel) / sum(sum(accel)) OVER (), 6) AS perc FROM g GROUP BY intensity, force_band, stance, side""")
def intensity_bands(spark, sf_dir):
    """Volume by intensity, force band, stance and side (2 exactly is high)."""
    f = F.col("force")
    intensity = F.when(f < 15, "low").when(f < 35, "moderate").otherwise("high")
    band = F.when(f < 2, "low").when((f > 2) & (f <= 3), "moderate").otherwise("high")
    g = steps(spark, sf_dir).groupBy(intensity.alias("intensity"), band.alias("force_band"), F.col("status").alias("stance"), "side").agg(F.count("*").alias("n"), F.sum("accel").alias("t"), F.round(F.avg("accel"), 4).alias("mean"))
    return g.select("intensity", "force_band", "stance", "side", "n", F.round("t", 2).alias("total"), "mean", F.round(100 * F.col("t") / F.sum("t").over(Window.partitionBy()), 6).alias("perc"))


FATIGUE = T + ", f AS (SELECT *, CAST(step AS INTEGER) % 4 AS tb, CASE WHEN force < 25 THEN 'low' ELSE 'high' END AS cma, CASE WHEN accel < 30000 THEN 'low' ELSE 'high' END AS grf FROM t)"


def _fatigue(spark, sf_dir):
    return steps(spark, sf_dir).withColumns({"tb": F.col("step") % 4, "cma": F.when(F.col("force") < 25, "low").otherwise("high"), "grf": F.when(F.col("accel") < 30000, "low").otherwise("high")})


@query(FATIGUE + """ SELECT status AS stance, coalesce(cma, '*') AS cma, coalesce(grf, '*') AS grf, coalesce(CAST(tb AS VARCHAR), '*') AS tb, count(*) AS n FROM f
GROUP BY GROUPING SETS ((status), (status, cma, grf), (status, cma, tb), (status, grf, tb), (status, cma), (status, grf), (status, tb))""")
def fatigue_grouping_sets(spark, sf_dir):
    """Seven grouping levels in one pass."""
    f = _fatigue(spark, sf_dir)
    sets = [("status",), ("status", "cma", "grf"), ("status", "cma", "tb"), ("status", "grf", "tb"), ("status", "cma"), ("status", "grf"), ("status", "tb")]
    g = f.groupingSets([[F.col(c) for c in s] for s in sets], "status", "cma", "grf", "tb").agg(F.count("*").alias("n"))
    star = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("*")).alias(c)
    return g.select(F.col("status").alias("stance"), star("cma"), star("grf"), star("tb"), "n")


@query(FATIGUE + """, g AS (SELECT cma, grf, status, count(*) FILTER (WHERE discount < 0.05) AS dec, count(*) FILTER (WHERE discount >= 0.05) AS inc FROM f GROUP BY ALL),
d AS (SELECT * FROM (VALUES ('low'), ('moderate'), ('high')) a(cma), (VALUES ('low'), ('moderate'), ('high')) b(grf), (VALUES ('F'), ('O')) c(status))
SELECT cma, grf, status, coalesce(dec, 0) AS dec, coalesce(inc, 0) AS inc FROM d LEFT JOIN g USING (cma, grf, status)""")
def fatigue_crosstab(spark, sf_dir):
    """Decreases and increases per cell; all 18 cells are kept."""
    g = _fatigue(spark, sf_dir).groupBy("cma", "grf", "status").agg(F.count_if(F.col("discount") < 0.05).alias("dec"), F.count_if(F.col("discount") >= 0.05).alias("inc"))
    cell = lambda c, *v: F.explode(F.array(*map(F.lit, v))).alias(c)
    grid = spark.range(1).select(cell("cma", "low", "moderate", "high")).select("cma", cell("grf", "low", "moderate", "high")).select("cma", "grf", cell("status", "F", "O"))
    return grid.join(g, ["cma", "grf", "status"], "left").na.fill(0, ["dec", "inc"])


@query(S + """, d AS (SELECT *, first_value(signal) OVER w AS y0, first_value(micros) OVER w AS t0, row_number() OVER w AS k FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
m AS (SELECT session_id, avg(ln(abs(signal) / abs(y0)) / ((micros - t0) / 1e9)) AS decay FROM d WHERE k > 5 AND micros > t0 GROUP BY session_id)
SELECT session_id, round(decay, 6) AS decay, abs((decay - avg(decay) OVER ()) / stddev_pop(decay) OVER ()) > 2 AS outlier FROM m""")
def decay_outliers(spark, sf_dir):
    """Mean log decay from the sixth value on, outliers across blocks; zeros give infinite decays, as floating point has them."""
    w = by_seq()
    d = samples(spark, sf_dir).select("*", F.first("signal").over(w).alias("y0"), F.first("micros").over(w).alias("t0"), F.row_number().over(w).alias("k")).where("k > 5 AND micros > t0")
    m = d.groupBy("session_id").agg(F.avg(H.ieee_log(H.ieee_ratio(F.abs("signal"), F.abs("y0"))) / ((F.col("micros") - F.col("t0")) / 1e9)).alias("decay"))
    stats = m.agg(F.avg("decay").alias("_m"), F.stddev_pop("decay").alias("_s"))  # one row
    return m.join(F.broadcast(stats)).select("session_id", F.round("decay", 6).alias("decay"), (F.abs(H.ieee_ratio(F.col("decay") - F.col("_m"), F.col("_s"))) > 2).alias("outlier"))


@query(S + ", n AS (SELECT *, count(*) OVER (PARTITION BY session_id) AS n FROM s) SELECT session_id, seq, CAST(least(ceil((seq + 1) / (n / 4.0)), 4) AS BIGINT) AS quarter FROM n")
def time_quarters(spark, sf_dir):
    """A18."""
    n = F.count("*").over(Window.partitionBy("session_id"))
    return samples(spark, sf_dir).select("session_id", "seq", F.least(F.ceil((F.col("seq") + 1) / (n / 4.0)), F.lit(4)).cast("long").alias("quarter"))


@query(T + " SELECT block_id, coalesce(sum(CASE WHEN side = 'LF' THEN force END), 0) AS total, coalesce(avg(CASE WHEN side = 'LF' THEN force END), 0) AS mean, round(coalesce(stddev_pop(CASE WHEN side = 'LF' THEN force END), 0), 6) AS std FROM t GROUP BY block_id")
def attribute_stats(spark, sf_dir):
    """Nulls left out, 0 when nothing is left."""
    own = _by_side("force", "LF")
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return steps(spark, sf_dir).groupBy("block_id").agg(z(F.sum(own)).alias("total"), z(F.avg(own)).alias("mean"), F.round(z(F.stddev_pop(own)), 6).alias("std"))


@query(T + """, a AS (SELECT block_id, (max(at_us) - min(at_us)) / 1e6 AS seconds, avg(CASE WHEN side = 'LF' THEN accel END) AS l, avg(CASE WHEN side = 'RF' THEN accel END) AS r, sum(CASE WHEN discount > 0.05 THEN 1 ELSE 0 END) AS over, count(*) AS n FROM t GROUP BY block_id)
SELECT block_id, seconds, round(abs(l - r) / greatest(l, r), 6) AS difference, round(100.0 * over / n, 6) AS perc_over, round(100 - 100.0 * over / n, 6) AS perc_under, CASE WHEN over * 2 >= n THEN 'over' ELSE 'under' END AS side FROM a""")
def percent_difference_summary(spark, sf_dir):
    """One row a block, with percent differences and the tie rule."""
    a = steps(spark, sf_dir).groupBy("block_id").agg(((F.max("at_us") - F.min("at_us")) / 1e6).alias("seconds"), F.avg(_by_side("accel", "LF")).alias("l"), F.avg(_by_side("accel", "RF")).alias("r"), F.count_if(F.col("discount") > 0.05).alias("over"), F.count("*").alias("n"))
    share = 100.0 * F.col("over") / F.col("n")
    return a.select("block_id", "seconds", F.round(F.abs(F.col("l") - F.col("r")) / F.greatest("l", "r"), 6).alias("difference"), F.round(share, 6).alias("perc_over"), F.round(100 - share, 6).alias("perc_under"), F.when(F.col("over") * 2 >= F.col("n"), "over").otherwise("under").alias("side"))


@query(S + """, v AS (SELECT session_id, list(phase ORDER BY seq) AS p FROM s GROUP BY session_id)
SELECT session_id, CASE WHEN len(list_filter(p, lambda x: x IN (2, 0))) > len(list_filter(p, lambda x: x IN (3, 1))) THEN 2 ELSE 4 END AS stance FROM v""")
def stance_vote(spark, sf_dir):
    """The stance that most samples of a step have."""
    g = samples(spark, sf_dir).groupBy("session_id").agg(F.count_if(F.col("phase").isin(2, 0)).alias("a"), F.count_if(F.col("phase").isin(3, 1)).alias("b"))
    return g.select("session_id", F.when(F.col("a") > F.col("b"), 2).otherwise(4).alias("stance"))


EDGES = (0, 5, 10, 20, 40, 60, 80, 100, 150, 200, 300, 1000)
BIN = "CASE " + " ".join(f"WHEN signal > {a} AND signal <= {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:]))) + " END"


@query(S + f", b AS (SELECT session_id, {BIN} AS bin FROM s) SELECT session_id, bin, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY session_id), 6) AS pct FROM b WHERE bin IS NOT NULL GROUP BY session_id, bin")
def histogram_percent(spark, sf_dir):
    """Histogram over uneven bins (open below, closed above), in percent."""
    bins = F.expr(BIN)
    b = samples(spark, sf_dir).select("session_id", bins.alias("bin")).where("bin IS NOT NULL").groupBy("session_id", "bin").agg(F.count("*").alias("n"))
    return b.select("session_id", "bin", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("session_id")), 6).alias("pct"))


_SPEARMAN = """WITH l AS (SELECT label, vec_id, unnest(range(1, 65)) AS i, unnest(embedding) AS x FROM embeddings), m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM l GROUP BY label, i),
x AS (SELECT vec_id, i, rank() OVER (PARTITION BY vec_id ORDER BY x) + (count(*) OVER (PARTITION BY vec_id, x) - 1) / 2.0 AS rx FROM l), p AS (SELECT label, i, rank() OVER (PARTITION BY label ORDER BY m) AS rm FROM m),
c AS (SELECT vec_id, label, round(corr(rx, rm), 6) AS rho FROM x JOIN p USING (i) GROUP BY vec_id, label)
SELECT vec_id, label, rho, row_number() OVER (PARTITION BY vec_id ORDER BY rho DESC, label) AS place FROM c"""


@query(_SPEARMAN)
def spearman_rank(spark, sf_dir):
    """Every recording against every mean profile."""
    return spearman_rank_all(spark, sf_dir)


@query(_SPEARMAN)
def spearman_rank_all(spark, sf_dir):
    """Conditions ranked by Spearman correlation with their mean profiles, for every recording.

    Each recording and each mean profile is ranked once; recordings meet the few profiles by place.
    """
    from stridelake.operators.windows import average_rank

    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    m = e.groupBy("label", "i").agg(F.avg("x").alias("m")).select("label", "i", average_rank("m", "label").alias("rm"))
    x = e.select("vec_id", "i", average_rank("x", "vec_id").alias("rx"))
    c = x.join(m, "i").groupBy("vec_id", "label").agg(F.round(F.corr("rx", "rm"), 6).alias("rho"))
    return c.withColumn("place", F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("rho"), "label")).cast("long"))


@query(S + " SELECT session_id, round((avg(signal*signal*signal) - 3*avg(signal)*avg(signal*signal) + 2*avg(signal)*avg(signal)*avg(signal)) / pow(stddev_pop(signal), 3), 5) AS skew FROM s GROUP BY session_id")
def skew_decision(spark, sf_dir):
    """Population skewness (the decision by it is ``left_right_by_skew``)."""
    return samples(spark, sf_dir).groupBy("session_id").agg(F.round(F.skewness("signal"), 5).alias("skew"))


@query(S + """, b AS (SELECT event_type AS state, min(micros) AS first, max(micros) AS last FROM s GROUP BY event_type)
SELECT state, (first - min(first) OVER ()) / 1000 AS entered_ms, (last - min(first) OVER ()) / 1000 AS left_ms FROM b""")
def state_timing(spark, sf_dir):
    """Offsets of the states' first and last events from the first of all."""
    b = samples(spark, sf_dir).groupBy(F.col("event_type").alias("state")).agg(F.min("micros").alias("a"), F.max("micros").alias("b"))
    first = F.min("a").over(Window.partitionBy())  # a row a state
    return b.select("state", ((F.col("a") - first) / 1000).alias("entered_ms"), ((F.col("b") - first) / 1000).alias("left_ms"))


MEDIAN_L, MEDIAN_R = ("quantile_cont(CASE WHEN side = '{}' THEN force END, 0.5)".format(s) for s in ("LF", "RF"))
KRUSKAL = T + """, u AS (SELECT *, CAST(floor(at_us / 2592000000000) AS BIGINT) AS bucket FROM t WHERE side IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY bucket ORDER BY force) + (count(*) OVER (PARTITION BY bucket, force) - 1) / 2.0 AS r, CAST(count(*) OVER (PARTITION BY bucket) AS DOUBLE) AS n, CAST(count(*) OVER (PARTITION BY bucket, force) AS DOUBLE) AS k FROM u),
a AS (SELECT bucket, any_value(n) AS n, sum(k * k - 1) AS ties, sum(CASE WHEN side = 'LF' THEN r END) AS rl, sum(CASE WHEN side = 'RF' THEN r END) AS rr, CAST(count(CASE WHEN side = 'LF' THEN 1 END) AS DOUBLE) AS nl, CAST(count(CASE WHEN side = 'RF' THEN 1 END) AS DOUBLE) AS nr,
  """ + MEDIAN_L + " AS ml, " + MEDIAN_R + """ AS mr FROM r GROUP BY bucket),
h AS (SELECT *, CASE WHEN n > 1 AND 1 - ties / (n*n*n - n) > 0 THEN (12 / (n*(n+1)) * (rl*rl/nl + rr*rr/nr) - 3*(n+1)) / (1 - ties / (n*n*n - n)) ELSE 0.0 END AS h FROM a WHERE nl > 0 AND nr > 0),
k AS (SELECT bucket, h, h >= 3.841458820694124 AND CASE WHEN least(ml, mr) = 0 THEN greatest(ml, mr) - least(ml, mr) >= 0.15 ELSE greatest(ml, mr) / least(ml, mr) > 1.15 END AS significant, ml, mr FROM h)
"""


def _kruskal(spark, sf_dir):
    t = steps(spark, sf_dir).withColumn("bucket", F.floor(F.col("at_us") / 2592000000000))
    return H.kruskal(t, ["bucket"], "side", "force")


@query(KRUSKAL + "SELECT bucket, round(h, 5) AS h, significant, ml AS median_left, mr AS median_right FROM k")
def kruskal_left_right(spark, sf_dir):
    """H1: left against right in each time bucket."""
    return _kruskal(spark, sf_dir).withColumn("h", F.round("h", 5))


@query(KRUSKAL + "SELECT quantile_cont(ml, 0.5) AS median_left, quantile_cont(mr, 0.5) AS median_right, count(*) FILTER (WHERE NOT significant) AS symmetric, count(*) FILTER (WHERE significant) AS asymmetric, CAST(round_even(100.0 * count(*) FILTER (WHERE significant) / count(*), 0) AS DOUBLE) AS percent FROM k")
def asymmetry_summary(spark, sf_dir):
    """Session summary of the tests."""
    k = _kruskal(spark, sf_dir)
    return k.agg(F.median("median_left").alias("median_left"), F.median("median_right").alias("median_right"), F.count_if(~F.col("significant")).alias("symmetric"), F.count_if("significant").alias("asymmetric"), F.bround(100.0 * F.count_if("significant") / F.count("*")).alias("percent"))


@query(T + """, l AS (SELECT side, CAST(step AS INTEGER) AS cadence, ln(force + 1) AS x, ln(accel + 1) AS y FROM t WHERE side IS NOT NULL),
a AS (SELECT * FROM (SELECT *, abs((x - avg(x) OVER p) / nullif(stddev_pop(x) OVER p, 0)) AS z FROM l WINDOW p AS (PARTITION BY side, cadence)) WHERE z <= 1.5),
b AS (SELECT * FROM (SELECT side, cadence, x, y, abs((y - avg(y) OVER p) / nullif(stddev_pop(y) OVER p, 0)) AS z FROM a WINDOW p AS (PARTITION BY side, cadence)) WHERE z <= 1.5),
f AS (SELECT side, cadence, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, count(*) AS n FROM b GROUP BY side, cadence)
SELECT side, cadence, round(slope, 5) AS slope, round(intercept, 5) AS intercept, round(sqrt((syy - slope * sxy) / (n - 2) / sxx), 6) AS se, round(slope / sqrt((syy - slope * sxy) / (n - 2) / sxx), 3) AS t, n FROM f WHERE n > 2 AND sxx > 0""")
def elasticity(spark, sf_dir):
    """H3, H6: elasticity of acceleration to force by side and cadence."""
    t = steps(spark, sf_dir).where("side IS NOT NULL").withColumn("cadence", F.col("step"))
    fit = H.elasticity(t, ["side", "cadence"], "force", "accel")
    return fit.select("side", "cadence", F.round("slope", 5).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("se", 6).alias("se"), F.round("t", 3).alias("t"), "n")


@query(T + """, g AS (SELECT side, status, CAST(step AS INTEGER) AS cadence, count(*) AS n, avg(accel) / avg(force) AS e FROM t WHERE side IS NOT NULL GROUP BY ALL)
SELECT side, coalesce(round(arg_max(CASE WHEN n >= 100 THEN e END, CASE WHEN n >= 100 THEN n * 10 - cadence END), 4), 0.0) AS elasticity FROM g GROUP BY side""")
def pattern_selection(spark, sf_dir):
    """Of results with enough observations the one with most, else 0."""
    g = steps(spark, sf_dir).where("side IS NOT NULL").groupBy("side", "status", "step").agg(F.count("*").alias("n"), (F.avg("accel") / F.avg("force")).alias("e"))
    enough = F.when(F.col("n") >= 100, F.col("n") * 10 - F.col("step"))
    return g.groupBy("side").agg(F.coalesce(F.round(F.max_by("e", enough), 4), F.lit(0.0)).alias("elasticity"))


QSUM = ", ".join(f"round(coalesce(sum(CASE WHEN force >= lo + (hi - lo) * {i} / 4.0 AND force <= lo + (hi - lo) * {i + 1} / 4.0 THEN force END), 0), 4) AS q{i + 1}" for i in range(4))


@query(T + f", b AS (SELECT side, status, force, min(force) OVER (PARTITION BY side, status) AS lo, max(force) OVER (PARTITION BY side, status) AS hi FROM t WHERE side IS NOT NULL) SELECT side, status, min(lo) AS lo, max(hi) AS hi, {QSUM} FROM b GROUP BY side, status")
def quarter_sums(spark, sf_dir):
    """H7: sums of four equal bins of each side's range, both ends inclusive."""
    t = steps(spark, sf_dir).where("side IS NOT NULL")
    bounds = t.groupBy("side", "status").agg(F.min("force").alias("lo"), F.max("force").alias("hi"))
    part = lambda i: F.round(F.coalesce(F.sum(F.when((F.col("force") >= F.col("lo") + (F.col("hi") - F.col("lo")) * i / 4.0) & (F.col("force") <= F.col("lo") + (F.col("hi") - F.col("lo")) * (i + 1) / 4.0), F.col("force"))), F.lit(0.0)), 4).alias(f"q{i + 1}")
    return t.join(F.broadcast(bounds), ["side", "status"]).groupBy("side", "status").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *(part(i) for i in range(4)))


@query(S + """, b AS (SELECT session_id, CAST(floor(micros / 259200000000) AS BIGINT) AS unit, min(micros) AS a, max(micros) AS z FROM s GROUP BY ALL), k AS (SELECT *, unnest(range(0, CAST(floor((z - a) / 21600000000.0) AS BIGINT) + 1)) AS i FROM b)
SELECT k.session_id, k.unit, i AS bucket, a + i * 21600000000 AS start, count(*) AS n, round(avg(signal), 6) AS mean FROM k JOIN s ON s.session_id = k.session_id AND s.micros BETWEEN k.a + i * 21600000000 AND k.a + (i + 1) * 21600000000 AND s.micros <= z AND CAST(floor(s.micros / 259200000000) AS BIGINT) = k.unit
GROUP BY k.session_id, k.unit, i, a""")
def time_blocks(spark, sf_dir):
    """H2: buckets anchored at each unit block, both ends inclusive (a boundary sample counts twice)."""
    width, unit = 21_600_000_000, F.floor(F.col("micros") / 259_200_000_000)
    s = samples(spark, sf_dir).withColumn("unit", unit)
    a = F.min("micros").over(Window.partitionBy("session_id", "unit"))
    placed = s.withColumn("a", a).withColumn("k", F.floor((F.col("micros") - F.col("a")) / width))
    edge = (F.col("micros") - F.col("a") == F.col("k") * width) & (F.col("k") > 0)
    both = placed.withColumn("bucket", F.explode(F.when(edge, F.array(F.col("k") - 1, F.col("k"))).otherwise(F.array("k"))))
    g = both.groupBy("session_id", "unit", "bucket", (F.col("a") + F.col("bucket") * width).alias("start"))
    return g.agg(F.count("*").alias("n"), F.round(F.avg("signal"), 6).alias("mean"))
