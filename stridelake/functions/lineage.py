"""Intermediate results that survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where that is unset a folder of the warehouse is taken on one machine; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def new_folder(spark: SparkSession, kind: str) -> str:
    """A name in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
