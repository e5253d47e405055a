"""Non-parametric tests, regressions and distribution statistics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators.windows import average_rank

#: 5 % point of chi-square with one degree of freedom; ratio and difference of medians.
CHI2_95, MEDIAN_RATIO, MEDIAN_DIFFERENCE = 3.841458820694124, 1.15, 0.15


def ieee_ratio(a: Column, b: Column) -> Column:
    """a / b of doubles as floating point has it: infinite or NaN over zero, in place of an error."""
    over_zero = F.when((a == 0) | F.isnan(a), float("nan")).when(a > 0, float("inf")).when(a < 0, float("-inf"))
    return F.when(b == 0, over_zero).otherwise(a / b)


def ieee_log(x: Column) -> Column:
    """ln(x) as floating point has it: -infinite at zero, NaN below, in place of null."""
    return F.when(x == 0, float("-inf")).when(x < 0, float("nan")).otherwise(F.log(x))


def rounded(x: Column, digits: int) -> Column:
    """x to so many digits as SQL's round(x, d) on doubles has it: the scaled double is rounded, not its shortest text (64.225 gives 64.22)."""
    scale = 10.0**digits
    return F.round(x * scale, 0) / scale


def kruskal(df: DataFrame, keys: list[str], side: str, value: str) -> DataFrame:
    """Kruskal-Wallis of two sides in each group: ``h``, ``significant`` and the medians.

    Equal values everywhere give h = 0.  With two sides the statistic has one degree of
    freedom.  Significant also needs medians that differ by a ratio (or, beside a zero
    median, by an amount).  Groups without both sides are left out.
    """
    clean = df.where(F.col(value).isNotNull() & F.col(side).isNotNull()).select(*keys, side, value)
    whole = Window.partitionBy(*keys)
    tie = F.count("*").over(Window.partitionBy(*keys, value)).cast("double")
    ranked = clean.withColumn("_r", average_rank(value, *keys)).withColumn("_n", F.count("*").over(whole).cast("double")).withColumn("_t", tie * tie - 1)
    part = lambda s, c: F.sum(F.when(F.col(side) == s, c))
    r = ranked.groupBy(*keys).agg(
        F.first("_n").alias("_n"), F.sum("_t").alias("_ties"), part("LF", F.col("_r")).alias("_rl"), part("RF", F.col("_r")).alias("_rr"), part("LF", F.lit(1.0)).alias("_nl"), part("RF", F.lit(1.0)).alias("_nr"),
        F.expr(f"percentile(CASE WHEN {side} = 'LF' THEN {value} END, 0.5)").alias("median_left"), F.expr(f"percentile(CASE WHEN {side} = 'RF' THEN {value} END, 0.5)").alias("median_right"),
    ).where("_nl IS NOT NULL AND _nr IS NOT NULL")
    n = F.col("_n")
    raw = 12 / (n * (n + 1)) * (F.col("_rl") ** 2 / F.col("_nl") + F.col("_rr") ** 2 / F.col("_nr")) - 3 * (n + 1)
    correction = 1 - F.col("_ties") / (n * n * n - n)
    h = F.when((n > 1) & (correction > 0), raw / correction).otherwise(0.0)
    lo, hi = F.least("median_left", "median_right"), F.greatest("median_left", "median_right")
    apart = F.when(lo == 0, hi - lo >= MEDIAN_DIFFERENCE).otherwise(hi / lo > MEDIAN_RATIO)
    return r.withColumn("h", h).select(*keys, "h", ((F.col("h") >= CHI2_95) & apart).alias("significant"), "median_left", "median_right")


def drop_outliers(df: DataFrame, keys: list[str], column: str, bound: float) -> DataFrame:
    """Rows whose z-score (population deviation) is at most ``bound``; no spread drops all."""
    w = Window.partitionBy(*keys)
    z = (F.col(column) - F.avg(column).over(w)) / F.nullif(F.stddev_pop(column).over(w), F.lit(0.0))
    return df.withColumn("_z", F.abs(z)).where(F.col("_z") <= bound).drop("_z")


def elasticity(df: DataFrame, keys: list[str], x: str, y: str, bound: float = 1.5) -> DataFrame:
    """Log-log regression of y on x after z-score trimming of x and then of y."""
    logs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.log(F.col(x) + 1).alias("_x"), F.log(F.col(y) + 1).alias("_y"))
    kept = drop_outliers(drop_outliers(logs, keys, "_x", bound), keys, "_y", bound)
    fit = kept.groupBy(*keys).agg(F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"), F.regr_sxx("_y", "_x").alias("_sxx"), F.regr_syy("_y", "_x").alias("_syy"), F.regr_sxy("_y", "_x").alias("_sxy"), F.count("*").alias("n"))
    se = F.sqrt((F.col("_syy") - F.col("slope") * F.col("_sxy")) / (F.col("n") - 2) / F.col("_sxx"))
    return fit.where("n > 2 AND _sxx > 0").withColumn("se", se).withColumn("t", F.col("slope") / F.nullif("se", F.lit(0.0))).select(*keys, "slope", "intercept", "se", "t", "n")


def side_stats(value: str, side: str, name: str, quantiles: tuple[int, ...] = (5, 50, 95)) -> list[Column]:
    """Mean, deviation and quantiles of both sides; null where either side is empty.

    With fewer than five values the deviation is null, and the lowest and highest quantiles
    are the minimum and maximum.
    """
    out = []
    n = {s: F.count(F.when(F.col(side) == s, F.col(value))) for s in ("LF", "RF")}
    both = (n["LF"] > 0) & (n["RF"] > 0)
    for s in ("LF", "RF"):
        own, many = F.when(F.col(side) == s, F.col(value)), n[s] >= 5
        out += [F.when(both, F.avg(own)).alias(f"{name}_{s.lower()}"), F.when(both & many, F.stddev_pop(own)).alias(f"{name}_{s.lower()}_std")]
        for q in quantiles:
            exact = F.percentile(own, F.lit(q / 100))
            few = F.min(own) if q < 50 else F.max(own) if q > 50 else exact
            out.append(F.when(both, F.when(many, exact).otherwise(few)).alias(f"{name}_{s.lower()}_{q}"))
    return out
