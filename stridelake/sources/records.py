"""Raw recordings: fixed-width binary scan, content dedupe, ordered parts, stage tables.

A record has 40 bytes: a 5-byte big-endian time in milliseconds, two bytes not read, and
for each of three sensors a flag byte, three 13-bit accelerations and three 13-bit parts of
a unit quaternion (5 bytes each).  Decoding uses built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stridelake.functions.lineage import cut

#: Fixed values of the format.
RECORD, EPOCH_MS, SENSORS, SCALE, JUMP_MS = 40, 1_530_000_000_000, (7, 18, 29), 32767.0, 300_000


def distinct_parts(parts: DataFrame, key: str = "part", content: str = "content", session: str = "session_id") -> DataFrame:
    """Of parts with the same bytes only the first by key."""
    digest = F.sha2(F.col(content).cast("binary"), 256)
    keep = parts.withColumn("_sha", digest).groupBy(session, "_sha").agg(F.min(key).alias(key)).drop("_sha")
    return parts.join(keep, [session, key], "left_semi")


def _whole(piece: Column, at: int, size: int) -> Column:
    return F.conv(F.hex(F.substring(piece, at + 1, size)), 16, 10).cast("long")


def _field(five: Column, shift: int) -> Column:
    """A signed 13-bit field, times 8."""
    u = F.shiftright(five, shift).bitwiseAND(8191)
    return F.when(u >= 4096, (u - 8192) * 8).otherwise(u * 8)


#: Rows of (session, part, place) are broadcast up to this number, so that contents do not move; beyond it they meet in a shuffle.
BROADCAST_PARTS = 500_000


def places(parts: DataFrame, session: str = "session_id", key: str = "part", content: str = "content") -> DataFrame:
    """``session, key, begin, tail``: where each part's bytes begin in its session, and the 39 bytes that follow it.

    Only lengths and the first 39 bytes of parts move.  Empty parts are left out; the bytes
    that follow may come from several short parts.
    """
    body = F.col(content).cast("binary")
    w = Window.partitionBy(session).orderBy(key)
    small = parts.select(session, key, F.length(body).cast("long").alias("size"), F.substring(body, 1, RECORD - 1).alias("head")).where("size > 0")
    begin = F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    heads = F.collect_list(F.hex("head")).over(w.rowsBetween(1, RECORD - 1))
    return small.select(session, key, begin.alias("begin"), F.substring(F.unhex(F.array_join(heads, "")), 1, RECORD - 1).alias("tail"))


def decode(parts: DataFrame, session: str = "session_id", key: str = "part", content: str = "content") -> DataFrame:
    """Samples of all parts, the bytes of a session's parts put one after the other by key.

    A record that is split over parts is whole again: record k of a session starts in the
    part that holds its first byte, and that part gets the first bytes of the next ones.
    Contents stay where they are while the places of all parts can be broadcast.
    """
    where = cut(places(parts, session, key, content))
    where = where.select(F.col(session).alias("_session"), F.col(key).alias("_key"), "begin", "tail")
    if where.count() <= BROADCAST_PARTS:
        where = F.broadcast(where)
    met = parts.select(session, key, F.col(content).cast("binary").alias("_c")).join(where, F.col(session).eqNullSafe(F.col("_session")) & (F.col(key) == F.col("_key")))
    first = F.ceil(F.col("begin") / RECORD)
    last = F.ceil((F.col("begin") + F.length("_c")) / RECORD) - 1
    whole = F.concat("_c", "tail")
    cuts = F.transform(F.sequence(first, last), lambda k: F.struct(k.alias("seq"), F.substring(whole, (k * RECORD - F.col("begin") + 1).cast("int"), F.lit(RECORD)).alias("r")))
    rows = met.where(last >= first).select(session, F.explode(cuts).alias("_x")).select(session, F.col("_x.seq").alias("seq"), F.col("_x.r").alias("_r")).where(F.length("_r") == RECORD)
    columns = [(_whole(F.col("_r"), 0, 5) + EPOCH_MS).alias("epoch_ms")]
    for k, at in enumerate(SENSORS):
        flag, acc, quat = (_whole(F.col("_r"), *x) for x in ((at, 1), (at + 1, 5), (at + 6, 5)))
        factor = F.when(F.shiftright(flag, 3).bitwiseAND(10) == 2, 4).otherwise(1)
        columns.append((flag.bitwiseAND(8) / 8).cast("int").alias(f"static_{k}"))
        columns += [(_field(acc, s) * factor).cast("double").alias(f"acc_{k}_{c}") for c, s in zip("xyz", (26, 13, 0))]
        parts_ = [_field(quat, s) / SCALE for s in (26, 13, 0)]
        square = sum((p * p for p in parts_[1:]), parts_[0] * parts_[0])
        columns.append(F.when(square > 1, F.lit(0.0)).otherwise(F.sqrt(F.greatest(1 - square, F.lit(0.0)))).alias(f"quat_{k}_w"))
        columns += [F.when(square > 1, p / F.sqrt(square)).otherwise(p).alias(f"quat_{k}_{c}") for c, p in zip("xyz", parts_)]
    return repair_times(rows.select(session, "seq", *columns), session)


def repair_times(samples: DataFrame, session: str = "session_id") -> DataFrame:
    """Times that run back take the mean of their neighbours; a jump over five minutes ends the session.

    Adds ``timestamp_error``: null, SMALL_NEGATIVE_JUMP or LARGE_JUMP_DATA_TRUNCATED.
    """
    w = Window.partitionBy(session).orderBy("seq")
    whole = Window.partitionBy(session)
    step = F.col("epoch_ms") - F.lag("epoch_ms").over(w)
    jump = F.min(F.when(F.abs(F.col("_d")) > JUMP_MS, F.col("seq"))).over(whole)
    back = (F.col("_d") < 0) & F.lead("epoch_ms").over(w).isNotNull()
    fixed = F.when(back, ((F.lag("epoch_ms").over(w) + F.lead("epoch_ms").over(w)) / 2).cast("long")).otherwise(F.col("epoch_ms"))
    marked = samples.withColumn("_d", F.coalesce(step, F.lit(10))).withColumn("_jump", jump).withColumn("_back", F.max((F.col("_d") < 0).cast("int")).over(whole)).withColumn("_t", fixed)
    error = F.when(F.col("_jump").isNotNull(), "LARGE_JUMP_DATA_TRUNCATED").when(F.col("_back") == 1, "SMALL_NEGATIVE_JUMP")
    kept = marked.where(F.col("_jump").isNull() | (F.col("seq") < F.col("_jump")))
    return kept.withColumn("epoch_ms", F.col("_t")).withColumn("timestamp_error", error).drop("_d", "_jump", "_back", "_t")


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Uploaded files named ``<session>_<millis>`` as parts."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(folder).select(F.regexp_extract(name, r"^(.*)_\d+$", 1).alias("session_id"), name.alias("part"), "content")


def write_stage(df: DataFrame, folder: str, session: str = "session_id", rows_a_file: int = 1_000_000) -> None:
    """A stage table by session; only the sessions at hand are replaced."""
    out = df.repartition(session).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_a_file)
    out.partitionBy(session).parquet(folder)


def read_stage(spark: SparkSession, folder: str, columns: list[str], session: str | None = None) -> DataFrame:
    """A stage table; one session prunes to its partition, columns reach the scan."""
    df = spark.read.parquet(folder)
    return (df if session is None else df.where(F.col("session_id") == session)).select(*columns)


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``changes`` replace rows of the same key; the last of repeated changes counts by ``updated``."""
    newest = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc("updated"))
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    return both.withColumn("_k", F.row_number().over(newest)).where("_k = 1").drop("_new", "_k")


def export_csv(df: DataFrame, folder: str) -> None:
    """A table as CSV files with a header each."""
    df.write.mode("error").option("header", True).csv(folder)


def scan_csv(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """CSV files with a header, read with a known schema (nothing is inferred)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(folder)


def delete_stage(spark: SparkSession, folder: str, sessions: Column, session: str = "session_id") -> int:
    """Deletes the partitions of the chosen sessions, and returns their number; others are not touched.

    Partitions are known by their folders, whose names are escaped; a folder that cannot be
    deleted is an error.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    names = [s.getPath().getName() for s in system.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(f"{session}=")]
    values = [(name, None if name.endswith("=__HIVE_DEFAULT_PARTITION__") else utils.unescapePathName(name.partition("=")[2])) for name in names]
    kind = spark.read.parquet(folder).schema[session].dataType
    chosen = spark.createDataFrame(values, f"_name string, `{session}` string").withColumn(session, F.col(session).cast(kind)).where(sessions).select("_name").collect()
    for row in chosen:
        if not system.delete(jvm.org.apache.hadoop.fs.Path(f"{root.toString()}/{row['_name']}"), True):
            raise OSError(f"could not delete {row['_name']} of {folder}")
    return len(chosen)


def chunk_at(samples: DataFrame, boundaries: DataFrame, session: str = "session_id") -> DataFrame:
    """Adds ``chunk``: how many of the session's boundaries lie at or before the sample."""
    marks = boundaries.select(session, "seq").distinct().withColumn("_mark", F.lit(1))
    marked = samples.join(marks, [session, "seq"], "left")
    w = Window.partitionBy(session).orderBy("seq")
    return marked.withColumn("chunk", F.sum(F.coalesce("_mark", F.lit(0))).over(w).cast("long")).drop("_mark")


def chunk_by_bytes(df: DataFrame, content: str, size: int) -> DataFrame:
    """One row a chunk of at most ``size`` bytes: ``part, start, chunk``; empty contents give one empty chunk."""
    n = F.octet_length(content)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size)).cast("array<long>"))
    cut = df.select("*", starts.alias("start"))
    return cut.withColumn("part", (F.col("start") / size).cast("int")).withColumn("chunk", F.substring(content, F.col("start").cast("int") + 1, F.lit(size))).drop(content)
