"""Cutting lineage on storage that outlives an executor."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure the session has a checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without one gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = context.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(named)


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and written out; later reads do not recompute it."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
