import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.sources import fs
from listenlake.sources.landing import (
    landing_schema,
    read_bronze_stream,
    read_landing_stream,
    stored_schema,
    widen,
)
from listenlake.sources.state import StateLog
from listenlake.streaming.bronze import run_bronze
from listenlake.streaming.layout import Layout


def ddl(text):
    return StructType.fromDDL(text)


def test_widen_appends_new_columns_and_rescues_what_does_not_fit(spark):
    known = ddl("a long, b string")
    assert widen(None, known) == known and widen(known, None) == known
    assert widen(known, ddl("b string, c int")) == ddl("a long, b string, c int")
    assert widen(ddl("a int, b float, c tinyint, d int"), ddl("a long, b double, c int, d float")) == ddl("a long, b double, c int, d double")
    assert widen(ddl("a long"), ddl("a smallint")) == ddl("a long")
    changed = ddl("a long, b string, _rescued variant")
    assert widen(known, ddl("a string")) == changed == widen(changed, ddl("a date, b long"))
    assert widen(ddl("a long"), ddl("a double")) == ddl("a long, _rescued variant")


def test_new_columns_reach_bronze_and_old_files_read_as_null(spark, root):
    layout = Layout(root)
    landing = layout.landing("t")
    steps = [
        spark.createDataFrame([(1, "x")], "id long, a string"),
        spark.createDataFrame([(2, "y", 5)], "id long, a string, b int"),
        spark.createDataFrame([(3,)], "id long"),
    ]
    for step in steps:
        step.write.mode("append").parquet(landing)
        run_bronze(spark, layout, ["t"])
    schema = stored_schema(StateLog(spark, layout.schema("t")))
    assert schema.names == ["id", "a", "b"]
    bronze = spark.read.option("mergeSchema", "true").parquet(layout.bronze("t"))
    got = sorted((r.id, r.a, r.b) for r in bronze.collect())
    assert got == [(1, "x", None), (2, "y", 5), (3, None, None)]
    row = bronze.first()
    assert row.input_file_path.startswith("file:") and row.ingest_date == row.ingest_timestamp.date()


def bronze_of(spark, layout):
    schema = stored_schema(StateLog(spark, layout.schema("t")))
    return spark.read.schema(schema).parquet(layout.bronze("t")).drop("batch")


@pytest.mark.parametrize("at_once", [False, True])
def test_changed_types_widen_or_are_rescued_and_nothing_is_lost(spark, root, at_once):
    layout = Layout(root)
    steps = [
        [(1, 5, 1.5, "x")], "id int, n int, f float, s string",
        [(2**40, 6, 2.25, "y")], "id long, n int, f double, s string",
        [("z9", 7, 3.0, 12), (None, 8, 4.0, None)], "id string, n int, f double, s long",
        [(3, dt.date(2024, 1, 2), 0.5, "w")], "id int, n date, f float, s string",
    ]
    for rows, kind in zip(steps[::2], steps[1::2]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(layout.landing("t"))
        if not at_once:
            run_bronze(spark, layout, ["t"])
    run_bronze(spark, layout, ["t"])
    found = bronze_of(spark, layout).withColumn("_rescued", F.to_json("_rescued")).collect()
    if not at_once:  # the first type that is seen stays; all at once, that is the one of the first file by name
        got = sorted(((r.id, r.n, r.f, r.s, json.loads(r._rescued or "null")) for r in found), key=repr)
        assert got == sorted([
            (1, 5, 1.5, "x", None), (2**40, 6, 2.25, "y", None), (None, 7, 3.0, None, {"id": "z9", "s": 12}), (None, 8, 4.0, None, None),
            (3, None, 0.5, "w", {"n": "2024-01-02"}),
        ], key=repr)
        assert dict(bronze_of(spark, layout).dtypes) == {"id": "bigint", "n": "int", "f": "double", "s": "string", "_rescued": "variant"}
    values = []
    for r in found:
        rescued = json.loads(r._rescued or "{}")
        values += [str(v) for v in (r.id, r.n, r.f, r.s, *rescued.values()) if v is not None]
    want = [1, 5, 1.5, "x", 2**40, 6, 2.25, "y", "z9", 7, 3.0, 12, 8, 4.0, 3, "2024-01-02", 0.5, "w"]
    assert sorted(values) == sorted(map(str, want))
    # and the table goes on as a stream
    stream = read_bronze_stream(spark, layout.bronze("t"), StateLog(spark, layout.schema("t")))
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 5


def test_a_batch_that_was_named_by_halves_is_written_anew(spark, root):
    layout = Layout(root)
    spark.createDataFrame([(1,), (2,)], "id long").write.parquet(layout.landing("t"))
    run_bronze(spark, layout, ["t"])
    (batch,) = [n for n in fs.children(spark, layout.bronze("t")) if n.startswith("batch=")]
    folder = f"{layout.bronze('t')}/{batch}"
    assert os.path.exists(f"{folder}/_SUCCESS")
    # as after a copy that broke off: some files, no mark, and the checkpoint doesn't know the batch yet
    os.remove(f"{folder}/_SUCCESS")
    os.remove(f"{folder}/{next(n for n in os.listdir(folder) if n.endswith('.parquet'))}")
    for commit in ("0", ".0.crc"):
        os.remove(f"{layout.checkpoint('bronze', 't')}/commits/{commit}")
    run_bronze(spark, layout, ["t"])
    assert sorted(r.id for r in bronze_of(spark, layout).collect()) == [1, 2]
    assert os.path.exists(f"{folder}/_SUCCESS")


def test_an_empty_landing_folder_is_reported(spark, root):
    with pytest.raises(FileNotFoundError):
        read_landing_stream(spark, f"{root}/none", StateLog(spark, f"{root}/state"))
