"""Cutting lineage with checkpoints in the cluster's shared folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it has at most so many bytes, counted before the join.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a fresh local one where that is unset, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        set_to = spark.conf.get("spark.checkpoint.dir", None)
        if set_to is None and sc.master.startswith("local"):
            set_to = tempfile.mkdtemp(prefix="gneiss-checkpoint-")
        if set_to is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(set_to)
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from a reliable checkpoint; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(side: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`side` with a broadcast hint if its counted rows of `row_bytes` fit the limit, else as it is.

    Give this a checkpointed frame: its rows are counted by a job of its own.
    """
    return F.broadcast(side) if side.count() * row_bytes <= limit else side
