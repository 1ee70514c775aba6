"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.expressions import column


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir`` or what ``setCheckpointDir`` was given. Without either a
    session on one machine gets a folder of its own; on a cluster that is an error, because
    executors would write to disks the others do not see.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = os.path.join(tempfile.gettempdir(), "scoreloom-checkpoints")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """Path nobody has written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/scoreloom/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and read it back, laid out by the given columns.

    Loops that read the same frame many times (search trials, boosting, evaluation) go on from
    this table: it outlives lost executors, and its rows and files do not change between reads.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[column(n) for n in df.columns])
