"""The registry that query modules fill, and the views that they share.

The test tables hold no sensor data, so queries read them through a mapping: events are
samples (a user is a session), embeddings hold quaternions, line items are steps and orders
their blocks, documents are uploaded parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, seq (from 0), micros, signal, phase, active, event_id, event_type."""
    e = table(spark, sf_dir, "events")
    phase = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "click", 2).when(F.col("event_type") == "purchase", 3).otherwise(0)
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.select(
        F.col("user_id").alias("session_id"), (F.row_number().over(order) - 1).cast("long").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
        F.col("value").alias("signal"), phase.alias("phase"), (F.col("value") >= 30).cast("int").alias("active"), "event_id", "event_type",
    )


#: The same view in SQL, to start a WITH list.
S = """WITH s AS (SELECT user_id AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, epoch_us(ts) AS micros, value AS signal,
  CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END AS phase, CAST(value >= 30 AS INTEGER) AS active, event_id, event_type FROM events)"""


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as steps: block_id, step, side (LF, RF, null), force, accel, at_us."""
    side = F.when(F.col("l_returnflag") == "A", "LF").when(F.col("l_returnflag") == "R", "RF")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("block_id"), F.col("l_linenumber").alias("step"), side.alias("side"), F.col("l_quantity").alias("force"), F.col("l_extendedprice").alias("accel"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("l_linestatus").alias("status"), F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("at_us"),
    )


T = """WITH t AS (SELECT l_orderkey AS block_id, l_linenumber AS step, CASE l_returnflag WHEN 'A' THEN 'LF' WHEN 'R' THEN 'RF' END AS side, l_quantity AS force, l_extendedprice AS accel,
  l_discount AS discount, l_tax AS tax, l_linestatus AS status, epoch_us(l_shipdate) AS at_us FROM lineitem)"""
