"""Places and exact quantiles in groups of any size, without a window over a whole group.

Rows are range-partitioned by (group, value).  A row's place is its place in its partition
plus the rows of its group in earlier partitions, so a hot group lies in as many tasks as
its rows need; only one row of each (partition, group) is summed by group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.lineage import cut


def placed(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``df`` with ``place`` (from 0, ascending, nulls first) and ``size`` of its group; equal values take any order."""
    ordered = cut(df.repartitionByRange(*keys, value).sortWithinPartitions(*keys, value))
    # Partitions of a checkpoint stay as they were written, so these numbers are stable.
    counted = ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn("_run", F.shiftright("_at", 33))
    runs = counted.groupBy(*keys, "_run").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    by = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_rows").over(by.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = cut(runs.select(*(F.col(k).alias(f"_key_{k}") for k in keys), F.col("_run").alias("_of"), "_first", before.alias("_before"), F.sum("_rows").over(by).alias("size")))
    same = F.col("_run") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    met = counted.join(runs, same)
    return met.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "size")


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear between neighbours) of each group, one column a share; nulls and NaN are left out."""
    number = F.col(value).cast("double")
    rows = placed(df.where(number.isNotNull() & ~F.isnan(number)).select(*keys, number.alias(value)), keys, value)
    out = []
    for name, share in shares.items():
        at = (F.col("size") - 1) * share
        # The two neighbours of the quantile weigh by their nearness; other rows weigh nothing.
        weight = F.greatest(1 - F.abs(F.col("place") - at), F.lit(0.0))
        out.append(F.sum(F.when(weight > 0, weight * F.col(value))).alias(name))
    return rows.groupBy(*keys).agg(*out)
