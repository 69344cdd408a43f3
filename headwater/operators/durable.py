"""Frames whose lineage ends in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table that an operator broadcasts, in bytes.
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, row_bytes: Column) -> DataFrame:
    """Marked for broadcast if its measured bytes fit the bound; else joined by shuffling. ``df`` should be durable: it is read once more."""
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address below the one named in ``spark.checkpoint.dir``; below a temporary one only in local mode, where it is unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="headwater-checkpoint-"))
    return f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder; lineage ends there."""
    shared_folder(df.sparkSession, "")
    return df.checkpoint(eager=True)
