"""Upload ingest, change events and online sessionization on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.functions.metadata import TRANSITIONS, changed
from stridelake.sources.records import upsert
from stridelake.streaming.online import online_blocks


def uploads(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New files of a folder as a stream of their rows."""
    return spark.readStream.schema(schema).parquet(folder)


def distinct_uploads(stream: DataFrame, at: str, digest: str, delay: str = "1 hour") -> DataFrame:
    """Equal contents within the watermark count once."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([digest])


def change_events(stream: DataFrame) -> DataFrame:
    """R2: changed attributes of records with ``old`` and ``new`` maps; records without a change go."""
    return stream.withColumn("changes", changed(F.col("new"), F.coalesce("old", F.create_map().cast("map<string,string>")))).where(F.size("changes") > 0)


def triggers(changes: DataFrame, attribute: str = "session_status", value: str = "UPLOAD_COMPLETE") -> DataFrame:
    """Changes that start the pipeline."""
    return changes.where(F.try_element_at("changes", F.lit(attribute)) == value)


def split_late(stream: DataFrame, status: str = "session_status") -> tuple[DataFrame, DataFrame]:
    """Uploads of sessions that are open, and the rejected ones for a side table."""
    is_open = F.col(status).isin("CREATE_COMPLETE", "UPLOAD_IN_PROGRESS")
    return stream.where(is_open), stream.where(~F.coalesce(is_open, F.lit(False)))


def active_blocks(stream: DataFrame, at: str, gap: str, delay: str, key: str = "session_id") -> DataFrame:
    """Blocks of activity; a gap of exactly ``gap`` still merges."""
    return stream.withWatermark(at, delay).groupBy(key, F.session_window(at, gap)).agg(F.count("*").alias("n"), F.sum("signal").alias("total"), F.min(at).alias("start"), F.max(at).alias("end"))


def tumbling(stream: DataFrame, at: str, width: str, delay: str, key: str = "session_id") -> DataFrame:
    """H2 aligned to the epoch: an addition, since the batch form is anchored at unit blocks."""
    return stream.withWatermark(at, delay).groupBy(key, F.window(at, width)).agg(F.count("*").alias("n"), F.avg("signal").alias("mean"))


def online_ranges(stream: DataFrame, at: str, delay: str, key: str = "session_id", silence_ms: int = 3_600_000) -> DataFrame:
    """Ranges of set flags, told when they close; a key that is silent for so long closes its range."""
    found = online_blocks(stream, at, delay, 0, 1 << 40, silence_ms, key)
    return found.where("kind = 'range'").select(key, "start", "end")


def apply_changes(current: DataFrame, batch: DataFrame, key: str = "session_id", status: str = "session_status") -> DataFrame:
    """A micro-batch merged into the sessions table.

    Creating a session that exists, and a change of state that is not allowed, do nothing.
    Both tables have the key, the state and ``updated``.
    """
    newest = Window.partitionBy(key).orderBy(F.desc("updated"))
    last = batch.withColumn("_k", F.row_number().over(newest)).where("_k = 1").drop("_k")
    old = current.select(F.col(key).alias("_key"), F.col(status).alias("_old"))
    met = last.join(old, F.col(key) == F.col("_key"), "left")
    allowed = F.concat_ws(">", "_old", status).isin(*(">".join(t) for t in TRANSITIONS))
    return upsert(current, met.where(F.col("_old").isNull() | allowed).drop("_key", "_old"), key)
