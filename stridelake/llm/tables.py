"""Reading of the corpus tables and the small Spark helpers that several operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``doc_id`` and ``text`` (or the named columns) of the whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id``, ``url`` and ``html`` of the whole ``pages`` table."""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset on one machine
    (tests) a folder of the warehouse is taken.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that lost executors lose nothing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As :func:`cut`, as a Parquet table: smaller where values repeat, such as hashes of common paths."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def block_of(key: Column, blocks: int) -> Column:
    """An even, deterministic spread of a key over ``blocks`` blocks."""
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def block_count(df: DataFrame, column: str, block_bytes: int, least: int = 8) -> int:
    """How many blocks of about ``block_bytes`` the column's bytes make; one narrow scan."""
    total = df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return max(least, -(-int(total) // block_bytes))


def skewed_join(many: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join of a side whose keys may be hot with a side of one row a key.

    Adaptive execution splits the partitions of hot keys and repeats only the matching rows of
    ``few`` there, at any size; nothing is salted in advance, so cold keys cost nothing more.
    A sort-merge join is asked for, since only that join is split, and only where both sides
    come straight from an exchange: an aggregate must be cut before it is ``few``.
    """
    return many.join(few.hint("merge"), keys, how)


def give_back() -> None:
    """Hands memory that a Python worker no longer uses back to the system.

    Workers are kept between tasks and stages, and their allocators would keep the peak.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):
    _trim = None


def lean(run: Callable) -> Callable:
    """A function of one or two groups (Arrow tables) that gives unused memory back at its end."""

    def after(*groups: pa.Table) -> pa.Table:
        try:
            return run(*groups)
        finally:
            give_back()

    if run.__code__.co_argcount == 2:
        return lambda left, right: after(left, right)
    return lambda group: after(group)


def lean_batches(run: Callable) -> Callable:
    """As :func:`lean`, for a function of an iterator of batches."""

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return after
