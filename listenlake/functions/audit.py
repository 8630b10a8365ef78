"""Audit columns stamped on rows as they enter bronze and silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BRONZE_AUDIT = ("input_file_path", "ingest_timestamp", "ingest_date")
SILVER_AUDIT = ("silver_ingest_timestamp", "bronze_ingest_timestamp", "input_file_path")


def add_bronze_audit(df: DataFrame) -> DataFrame:
    """Needs a frame read straight from files: the path comes from the file metadata column."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("input_file_path"),
        F.current_timestamp().alias("ingest_timestamp"),
        F.current_date().alias("ingest_date"),
    )


def add_silver_audit(df: DataFrame) -> DataFrame:
    """The bronze ingest time moves to its own name beside the silver one."""
    return df.withColumnsRenamed({"ingest_timestamp": "bronze_ingest_timestamp"}).withColumn(
        "silver_ingest_timestamp", F.current_timestamp()
    )
