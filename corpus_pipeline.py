"""The corpus pipeline: quality rules, near duplicates, repeated strings, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``.  Between stages the documents are written as
Parquet to the shared folder, so that lost executors cost only the running stage.

Document ids are taken as unique.  Null and empty texts, extra columns and empty tables
pass as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import jaccard_join, personal_data, quality_rules, sequence_packing, suffix_dedup, tables


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, with the length of the new text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines."""
    # The row number keeps the verdict's long expressions in one place: a filter on them alone
    # would be pushed down through every projection, copying them at each step.
    row = tables.fresh(docs, "_row")
    judged = quality_rules.clean_lines(docs).withColumn(row, F.monotonically_increasing_id())
    kept = judged.where(F.col("kept") & (F.col(row) >= 0)).withColumn("text", F.col("clean_text"))
    return _counted(kept, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    others = jaccard_join.similar(docs.select("doc_id", "text")).where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that an earlier document has."""
    return _counted(suffix_dedup.cleaned(docs), docs.columns)


def private_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _counted(personal_data.redacted(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    pieces = sequence_packing.token_pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")
    return sequence_packing.pack(tables.cut(pieces)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("personal data", private_spans),
    ("best-fit packing", packing),
]

#: Tokens, components and repeats are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{tables.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
