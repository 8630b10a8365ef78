from pyspark.sql import functions as F

from listenlake.sources.snapshot import PART, SnapshotTable
from listenlake.sources.state import StateLog


def rows(spark, pairs):
    return spark.createDataFrame(pairs, f"id long, {PART} string")


def ids(table, parts=None):
    return sorted(r.id for r in table.read(parts).collect())


def test_parts_are_replaced_or_grow(spark, root):
    table = SnapshotTable(spark, root, "id long")
    assert ids(table) == [] and table.head().version == 0
    table.publish(rows(spark, [(1, "current"), (2, "current")]), 0, replaces=["current"])
    table.publish(rows(spark, [(3, "current"), (1, "history")]), 1, replaces=["current"])
    table.publish(rows(spark, [(4, "current"), (3, "history")]), 2, replaces=["current"])
    assert ids(table) == [1, 3, 4]
    assert ids(table, ["history"]) == [1, 3] and ids(table, ["nothing"]) == []
    assert table.done(2) and not table.done(3)
    table.publish(rows(spark, [(9, "all")]), 3)
    assert ids(table) == [9]


def test_an_uncommitted_write_is_invisible_and_is_redone(spark, root):
    table = SnapshotTable(spark, root, "id long")
    table.publish(rows(spark, [(1, "a")]), 0)
    # a crash after the data of version 2, before its commit
    spark.range(5).withColumn(PART, F.lit("a")).write.partitionBy(PART).parquet(
        f"{root}/data/v=00000002"
    )
    assert ids(table) == [1]
    table.publish(rows(spark, [(2, "a")]), 1)
    assert ids(table) == [2]


def test_a_reader_keeps_the_version_it_opened(spark, root):
    table = SnapshotTable(spark, root, "id long")
    table.publish(rows(spark, [(1, "a")]), 0)
    before = table.read()
    table.publish(rows(spark, [(2, "a")]), 1)
    assert [r.id for r in before.collect()] == [1]


def test_vacuum_keeps_what_recent_commits_name(spark, root):
    table = SnapshotTable(spark, root, "id long")
    for i in range(4):
        pairs = [(i, "current"), (10 + i, "history")]
        table.publish(rows(spark, pairs), i, replaces=["current"])
    gone = [x.partition("-")[0] + "/" + x.rpartition("/")[2] for x in table.vacuum(keep=2)]
    assert gone == ["data/v=00000001/part=current", "data/v=00000002/part=current"]
    assert ids(table) == [3, 10, 11, 12, 13]
    assert table.vacuum(keep=2) == []


def test_state_ignores_entries_that_were_not_finished(spark, root):
    log = StateLog(spark, f"{root}/log")
    assert log.latest() is None
    log.append({"n": 1})
    spark.range(1).selectExpr("'broken' AS value").write.text(f"{root}/log/000000000002")
    (__import__("pathlib").Path(root) / "log/000000000002/_SUCCESS").unlink()
    assert log.latest() == {"n": 1}
    log.append({"n": 2, "text": "ü \n \" x"})
    assert log.latest() == {"n": 2, "text": "ü \n \" x"}
