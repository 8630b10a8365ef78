"""Landing folders to bronze tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from listenlake import fixed
from listenlake.functions.audit import add_bronze_audit
from listenlake.sources import fs
from listenlake.sources.landing import BATCH, NO_COLUMN, files_with_all_columns, fitted, read_landing_stream, stored_schema
from listenlake.sources.state import StateLog, stream_id
from listenlake.streaming.layout import Layout


# what Spark leaves in a folder once all of it is written
DONE = "_SUCCESS"


def write_bronze(df: DataFrame, path: str, checkpoint: str, store: StateLog | None = None) -> StreamingQuery:
    """Append-only and exactly once: the checkpoint knows the files taken in.

    With ``store`` every micro-batch is read with all columns that its own files have, and new ones are
    remembered there, so a file that came after the stream's schema was looked up loses nothing.
    A batch is written aside and then named; one that is there with the mark of a complete write is done. Where
    naming copies, as on object stores, a copy that broke off lacks the mark, which is copied last, and is made anew.
    """
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if store is None:
        return writer.format("parquet").outputMode("append").start(path)
    spark, name = df.sparkSession, stream_id(df.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/{BATCH}={batch_id:012d}-{name[:12]}"
        if fs.exists(spark, f"{target}/{DONE}"):
            return
        fs.delete(spark, target)
        staged = f"{path}/_staged/{name}-{batch_id}"
        rows = files_with_all_columns(batch, store, add_bronze_audit)
        # an empty batch is written too, so that the table is there to be read
        found = fitted(batch.drop(NO_COLUMN), stored_schema(store)) if rows is None else rows
        found.write.mode("overwrite").parquet(staged)
        fs.rename(spark, staged, target, last=DONE)

    return writer.foreachBatch(write).start()


def run_bronze(
    spark: SparkSession, layout: Layout, names: Iterable[str], max_files: int = fixed.MAX_FILES
) -> None:
    """All tables at once, one streaming query each; returns when every one has caught up."""
    queries = []
    for name in names:
        store = StateLog(spark, layout.schema(name))
        stream = read_landing_stream(spark, layout.landing(name), store, max_files, columns=False)
        queries.append(
            write_bronze(
                add_bronze_audit(stream), layout.bronze(name), layout.checkpoint("bronze", name), store
            )
        )
    for query in queries:
        query.awaitTermination()
