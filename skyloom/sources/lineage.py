"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _base(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A temporary folder is set only where that is unset and all runs on one machine, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() in spark.checkpoint.dir."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(_base(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below spark.checkpoint.dir."""
    return f"{_base(spark).rstrip('/')}/skyloom-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as files in the shared folder, read back: for tables that a plan uses several times."""
    path = shared_folder(df.sparkSession)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
