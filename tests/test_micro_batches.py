"""What a micro-batch of the silver layer costs: rows of a task, parts looked into, batches of a landed file."""

from pyspark.sql import functions as F

from listenlake import fixed
from listenlake.operators.rules import Rule
from listenlake.plans import silver
from listenlake.registry import ingest
from listenlake.sources.snapshot import SnapshotTable


def plays(spark, rows):
    """(stream, day, seconds) as a bronze batch."""
    df = spark.createDataFrame(rows, "stream_id long, date_key int, listen_duration int").coalesce(1)
    at = F.to_timestamp(F.col("date_key").cast("string"), "yyyyMMdd")
    df = df.select(
        "stream_id", F.lit(1).cast("long").alias("user_id"), F.lit(2).cast("long").alias("track_id"), "date_key",
        "listen_duration", F.lit("R").alias("device_type"), at.alias("stream_timestamp"),
    )
    return df.withColumns({"input_file_path": F.lit("plays.parquet"), "ingest_timestamp": F.current_timestamp()})


def test_rows_of_one_block_are_spread_over_tasks(spark, root, monkeypatch):
    monkeypatch.setattr(silver, "TASK_ROWS", 100)
    batch = plays(spark, [(i % 7, 20240101, i % 5) for i in range(1000)])
    assert batch.rdd.getNumPartitions() == 1
    rules = (Rule("none", "listen_duration = 0"),)
    valid, counts = silver._valid_rows(batch, 0, "FactStream", "stream_id", rules, root)
    assert counts == {"valid_rows": 800, "invalid_rows": 200, "soft_failures": 0}
    per_task = [row.n for row in valid.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per_task) == 800 and max(per_task) <= 200
    few, _ = silver._valid_rows(batch.limit(90), 1, "FactStream", "stream_id", rules, root)
    assert few.rdd.getNumPartitions() == 1
    assert spark.read.parquet(root).columns == [
        "natural_key", "raw_record", "dq_fail_reason", "quarantine_timestamp", "input_file_path", "source_table", "batch_id",
    ]


def test_parts_that_a_batch_rewrites_anyway_are_not_looked_into(spark, root, monkeypatch):
    table = SnapshotTable(spark, f"{root}/facts", silver.FACT_DDL, "stream_id")
    silver.apply_fact_batch(plays(spark, [(1, 20240105, 3), (2, 20240205, 3), (3, 20240305, 3)]), 0, table, f"{root}/log")
    asked, read = [], SnapshotTable.read

    def told(self, parts=None, head=None):
        asked.append(None if parts is None else sorted(parts))
        return read(self, parts, head)

    monkeypatch.setattr(SnapshotTable, "read", told)
    monkeypatch.setattr(silver, "FEW_KEYS", -1)
    # a batch of all months, one of whose plays moves from the first to the second
    silver.apply_fact_batch(plays(spark, [(1, 20240207, 4), (4, 20240105, 4), (5, 20240305, 4)]), 1, table, f"{root}/log")
    assert asked == [["202401", "202402", "202403"]]
    asked.clear()
    # one of a single month: the play that it moves lies in one of the two others
    silver.apply_fact_batch(plays(spark, [(3, 20240110, 5)]), 2, table, f"{root}/log")
    assert asked == [["202402", "202403"], ["202401", "202403"]]
    monkeypatch.undo()
    found = {r.stream_id: (r.date_key, r.listen_duration) for r in table.read().collect()}
    assert found == {1: (20240207, 4), 2: (20240205, 3), 3: (20240110, 5), 4: (20240105, 4), 5: (20240305, 4)}


def test_a_landed_file_is_a_micro_batch_however_many_files_bronze_has(spark, monkeypatch):
    run, versions = ingest.run_bronze, []

    def in_small_files(*args, **kwargs):
        spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
        try:
            run(*args, **kwargs)
        finally:
            spark.conf.unset("spark.sql.files.maxRecordsPerFile")

    def read(layer):
        versions.append(layer.facts.head().version)
        return layer.facts.read().select("stream_id", "listen_duration")

    monkeypatch.setattr(ingest, "run_bronze", in_small_files)
    rows = plays(spark, [(i % 60, 20240101 + i // 60, 1 + i % 9) for i in range(240)])
    found = ingest._cut(spark, "FactStream", rows.drop("input_file_path", "ingest_timestamp"), fixed.PLANS, read)
    assert versions[0] <= ingest.SCRAMBLED_FILES and versions[1] == 1
    newest = {i % 60: 1 + i % 9 for i in range(240)}
    for files in ingest.CUTS:
        assert {r.stream_id: r.listen_duration for r in found.where(F.col("max_files") == files).collect()} == newest
