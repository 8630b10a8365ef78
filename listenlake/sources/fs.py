"""The few file-system calls Spark has no DataFrame API for, on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _open(spark, path)
    return fs.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if there is no such folder."""
    fs, hadoop = _open(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop))


def rename(spark: SparkSession, path: str, target: str, last: str) -> None:
    """Move a folder to a name that doesn't exist yet; the file named ``last`` comes after all others.

    Moving is one step on file systems that have folders; others copy file by file, and may break off between.
    """
    fs, hadoop = _open(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(at(target).getParent())
    marked = at(f"{path}/{last}")
    held = at(f"{path}.{last}")
    # the mark waits beside the folder; one of an earlier move that broke off may still be there
    fs.delete(held, False)
    if not (fs.rename(marked, held) and fs.rename(hadoop, at(target)) and fs.rename(held, at(f"{target}/{last}"))):
        raise OSError(f"{path} could not be renamed to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _open(spark, path)
    fs.delete(hadoop, True)
