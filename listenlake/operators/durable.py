"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from listenlake.sources import fs

CHECKPOINT_CONF = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="listenlake-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own, once.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        folder = _local_folder()
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/listenlake/{spark.conf.get('spark.app.id', 'app')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has materialised, once nothing reads it any more."""
    fs.delete(spark, _own_folder(spark))


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the frame once and go on from the files.

    Parquet rather than an RDD checkpoint: it is compressed and later reads prune columns.
    Values drawn from the physical layout (row positions, partition ids) are frozen by the write,
    so a retried task cannot see other ones.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
