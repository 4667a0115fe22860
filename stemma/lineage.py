"""Cutting of lineage where a result is read several times, and the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the driver and all executors share.

    Only where a local session names no folder, a temporary one is used; on a cluster that is a RuntimeError.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
