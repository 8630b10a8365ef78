"""Where rows that fail a hard rule go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.operators.rules import REASON, VALID

HELPERS = (VALID, REASON)


def to_quarantine(
    invalid: DataFrame, source_table: str, key: str, path_col: str = "input_file_path"
) -> DataFrame:
    """One log row per bad row: its key as text, the whole row as JSON, and why it failed.

    Rule helper columns are left out of the JSON, since the log has its own reason column.
    """
    record = F.struct(*[c for c in invalid.columns if c not in HELPERS])
    # The six columns of the log.
    return invalid.select(
        F.lit(source_table).alias("source_table"),
        F.col(key).cast("string").alias("natural_key"),
        F.to_json(record).alias("raw_record"),
        F.col(REASON),
        F.current_timestamp().alias("quarantine_timestamp"),
        F.col(path_col).alias("input_file_path"),
    )


def write_quarantine(log: DataFrame, root: str, batch_id: int) -> None:
    """Replaying a batch replaces its own rows, so the log never doubles. No rows write nothing."""
    tables = log.withColumn("batch_id", F.lit(batch_id))
    (
        tables.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_table", "batch_id")
        .parquet(root)
    )
