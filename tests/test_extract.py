import datetime as dt

from listenlake.sources.extract import (
    SourceSpec,
    advance_watermark,
    extract_incremental,
    ingest,
    ingest_all,
    mark_log,
    parquet_source,
    read_watermark,
)


def source(spark, root, days):
    rows = [(d, dt.datetime(2024, 1, d, 12, 0, 0, 250000)) for d in days]
    spark.createDataFrame(rows, "id long, updated_at timestamp").write.mode("append").parquet(root)


def landed(spark, root, name="orders"):
    return sorted(r.id for r in spark.read.parquet(f"{root}/landing/{name}").collect())


def test_runs_take_only_what_is_new(spark, root):
    source(spark, f"{root}/src", [1, 2])
    spec = SourceSpec("orders", "updated_at", parquet_source(f"{root}/src"))
    args = (f"{root}/landing", f"{root}/marks")
    assert ingest(spark, spec, *args).rows == 2
    second = ingest(spark, spec, *args)
    assert (second.rows, second.mark) == (0, "2024-01-02 12:00:00.25")
    assert landed(spark, root) == [1, 2]
    source(spark, f"{root}/src", [3])
    assert [x.rows for x in ingest_all(spark, [spec], *args)] == [1]
    assert landed(spark, root) == [1, 2, 3]


def test_backfill_overrides_the_mark_and_never_lowers_it(spark, root):
    source(spark, f"{root}/src", [1, 2, 3])
    args = (f"{root}/landing", f"{root}/marks")
    read = parquet_source(f"{root}/src")
    ingest(spark, SourceSpec("orders", "updated_at", read), *args)
    back = SourceSpec("orders", "updated_at", lambda s: read(s).filter("id < 3"), "2024-01-02")
    again = ingest(spark, back, *args)
    assert (again.rows, again.mark) == (1, "2024-01-03 12:00:00.25")
    assert landed(spark, root) == [1, 2, 2, 3]


def test_numbers_are_compared_as_numbers(spark, root):
    log = mark_log(spark, root, "t")
    assert advance_watermark(log, spark.range(10), "id") == "9"
    assert advance_watermark(log, spark.range(11), "id") == "10"
    assert advance_watermark(log, spark.range(3), "id") == "10"
    assert advance_watermark(log, spark.range(0), "id") == "10"
    assert read_watermark(log) == "10"
    assert [r.id for r in extract_incremental(spark.range(13), "id", "10").collect()] == [11, 12]


def test_first_run_of_an_empty_source_lands_nothing(spark, root):
    spec = SourceSpec("orders", "id", lambda s: s.range(0))
    got = ingest(spark, spec, f"{root}/landing", f"{root}/marks")
    assert (got.rows, got.mark) == (0, None)


def test_overlap_catches_rows_at_the_mark(spark, root):
    source(spark, f"{root}/src", [1, 2])
    df = spark.read.parquet(f"{root}/src")
    mark = "2024-01-02 12:00:00.25"
    assert extract_incremental(df, "updated_at", mark).count() == 0
    assert extract_incremental(df, "updated_at", mark, overlap="1 hour").count() == 1


def test_the_bound_reaches_the_scan(spark, root):
    source(spark, f"{root}/src", [1, 2])
    df = extract_incremental(spark.read.parquet(f"{root}/src"), "updated_at", "2024-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at,2024-01-01" in plan
