"""Incremental extraction and the streaming layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake import fixed
from listenlake.functions.audit import add_bronze_audit
from listenlake.operators.durable import scratch_path
from listenlake.operators.cdc import versions
from listenlake.registry.history import CUT, USER_EVENTS, scd1_sql, user_events
from listenlake.registry.sql import LINES, STAR
from listenlake.sources import sample
from listenlake.sources.extract import (
    SourceSpec,
    advance_watermark,
    extract_incremental,
    ingest_all,
    mark_log,
    parquet_source,
    read_watermark,
)
from listenlake.sources.landing import read_landing_stream, stored_schema
from listenlake.sources.state import StateLog
from listenlake.streaming.bronze import run_bronze, write_bronze
from listenlake.streaming.layout import Layout
from listenlake.streaming.silver import SOURCES, SilverLayer

LAST = "1997-06-15 00:00:00"
BACKFILL = "1995-01-01"


def incr_extract(spark, sf_dir) -> DataFrame:
    return extract_incremental(sample.table(spark, sf_dir, "orders"), "o_orderdate", LAST)


def incr_backfill(spark, sf_dir) -> DataFrame:
    orders = sample.table(spark, sf_dir, "orders")
    return extract_incremental(orders, "o_orderdate", LAST, BACKFILL)


def watermark_max(spark, sf_dir) -> DataFrame:
    """The mark after a run over all orders, as read back from the state."""
    log = mark_log(spark, scratch_path(spark, "marks"), "orders")
    advance_watermark(log, sample.table(spark, sf_dir, "orders"), "o_orderdate")
    return spark.range(1).select(F.lit(read_watermark(log)).alias("cdc"))


INCREMENTAL = {
    "orders": "o_orderdate",
    "lineitem": "l_shipdate",
    "events": "ts",
    "customer": "c_custkey",
}


def incr_all_tables(spark, sf_dir) -> DataFrame:
    """Two runs over all tables: the first lands everything, the second finds nothing new."""
    landing, marks = scratch_path(spark, "landing"), scratch_path(spark, "marks")
    specs = [
        SourceSpec(name, col, parquet_source(f"{sf_dir}/{name}.parquet"))
        for name, col in INCREMENTAL.items()
    ]
    ingest_all(spark, specs, landing, marks)
    again = {landed.name: landed for landed in ingest_all(spark, specs, landing, marks)}
    parts = [
        spark.read.parquet(f"{landing}/{name}").agg(
            F.lit(name).alias("source_table"),
            F.count(F.lit(1)).alias("landed_rows"),
            F.max(col).cast("string").alias("highest"),
            F.lit(again[name].mark == read_watermark(mark_log(spark, marks, name))).alias("kept"),
            F.lit(again[name].rows).cast("bigint").alias("second_run_rows"),
        )
        for name, col in INCREMENTAL.items()
    ]
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def bronze_ingest(spark, sf_dir) -> DataFrame:
    """All events through the bronze stream, run twice: the second run adds nothing."""
    target, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    store = StateLog(spark, scratch_path(spark, "schema"))
    # a file stream watches a folder; the name picks the table's file in it
    named = {"pathGlobFilter": "events.parquet"}
    for _ in range(2):
        stream = read_landing_stream(spark, sf_dir, store, options=named)
        write_bronze(add_bronze_audit(stream), target, checkpoint, store).awaitTermination()
    return spark.read.parquet(target).select(
        *stored_schema(store).names,
        F.element_at(F.split("input_file_path", "/"), -1).alias("file_name"),
        (F.to_date("ingest_timestamp") == F.col("ingest_date")).alias("dated"),
    )


def silver_stream(spark, sf_dir) -> DataFrame:
    """All plays land in two steps, and after each flow through bronze to the silver fact."""
    layout = Layout(scratch_path(spark, "warehouse"))
    plays = sample.fact(spark, sf_dir).select(*sample.FACT_COLS).withColumn(
        "stream_timestamp", F.col("stream_timestamp").cast("timestamp")
    )
    layer = SilverLayer(spark, layout, sequenced=False)
    earlier = F.col("stream_timestamp") < F.lit(CUT).cast("timestamp")
    for step in (plays.filter(earlier), plays.filter(~earlier)):
        step.write.mode("append").parquet(layout.landing("FactStream"))
        run_bronze(spark, layout, ["FactStream"])
        layer.run(["FactStream"])
    return layer.facts.read().select(*sample.FACT_COLS)


SCRAMBLED_FILES = 5
CUTS = (1, 1000)


def _cut(spark, name: str, events: DataFrame, plans, read) -> DataFrame:
    """The same landing, its events in no order over its files, taken in by one file at a time and all at once.

    Bronze has several files for a landed one that is large, as several tasks read it. Silver takes as many at a time,
    so that there is a micro-batch for a landed file, however large it is.
    """
    found, source = [], SOURCES.get(name, name)
    first = Layout(scratch_path(spark, "warehouse"))
    events.repartition(SCRAMBLED_FILES, F.xxhash64(*events.columns)).write.parquet(first.landing(source))
    for files in CUTS:
        layout = Layout(scratch_path(spark, "warehouse"), feed=first.root)
        run_bronze(spark, layout, [source], max_files=files)
        landed, held = (len(spark.read.parquet(path).inputFiles()) for path in (layout.landing(source), layout.bronze(source)))
        layer = SilverLayer(spark, layout, plans, max_files=-(-files * held // landed))
        layer.run([name])
        found.append(read(layer).withColumn("max_files", F.lit(files)))
    return found[0].unionByName(found[1])


def silver_facts_cut(spark, sf_dir) -> DataFrame:
    """Facts however their files are cut into micro-batches: the newest event of each stream."""
    plays = sample.fact(spark, sf_dir).select(*sample.FACT_COLS).withColumn(
        "stream_timestamp", F.col("stream_timestamp").cast("timestamp")
    )
    return _cut(spark, "FactStream", plays, fixed.PLANS, lambda layer: layer.facts.read().select(*sample.FACT_COLS))


def silver_users_cut(spark, sf_dir) -> DataFrame:
    """User versions however their files are cut into micro-batches: an interval for each change."""
    events = user_events(spark, sf_dir).drop("o_orderkey", "o_orderstatus")
    cols = ["user_id", *fixed.USER_TRACKED_COLS, "start_at", "end_at"]
    plans = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
    return _cut(spark, "DimUserHistory", events, plans, lambda layer: versions(layer.user_history.read()).select(*cols))


def silver_dims(spark, sf_dir) -> DataFrame:
    """Artists, tracks and days through the streams, keys and audit columns added on the way."""
    layout = Layout(scratch_path(spark, "warehouse"))
    at = F.lit("2024-01-01").cast("timestamp")
    landed = {
        "DimArtist": sample.artists(spark, sf_dir).drop("artist_sk").withColumn("updated_at", at),
        "DimTrack": sample.tracks(spark, sf_dir).drop("track_sk").withColumn("updated_at", at),
        "DimDate": sample.dates(spark, sf_dir),
    }
    for name, df in landed.items():
        df.write.parquet(layout.landing(name))
    run_bronze(spark, layout, list(landed))
    layer = SilverLayer(spark, layout)
    layer.run(list(landed))
    audited = F.col("silver_ingest_timestamp").isNotNull() & F.col("input_file_path").isNotNull()
    rows = [
        (layer.artists.read(), "artist", "artist_id", "artist_sk", "artist_name", audited),
        (layer.tracks.read(), "track", "track_id", "track_sk", "track_name", audited),
        (layer.dates.read(), "date", "date_key", "date_key", "weekday", F.lit(True)),
    ]
    parts = [
        df.select(
            F.lit(kind).alias("dimension"), F.col(key).cast("bigint").alias("key"), F.col(sk).cast("bigint").alias("number"),
            F.col(name).alias("name"), seen.alias("audited"),
        )
        for df, kind, key, sk, name, seen in rows
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {
    "incr_extract": incr_extract,
    "incr_backfill": incr_backfill,
    "watermark_max": watermark_max,
    "incr_all_tables": incr_all_tables,
    "bronze_ingest": bronze_ingest,
    "silver_stream": silver_stream,
    "silver_facts_cut": silver_facts_cut,
    "silver_users_cut": silver_users_cut,
    "silver_dims": silver_dims,
}


def _landed(name: str, col: str, text: str) -> str:
    return f"""SELECT '{name}' AS source_table, count(*) AS landed_rows, {text} AS highest,
       true AS kept, CAST(0 AS BIGINT) AS second_run_rows FROM {name}"""


FACT_TIES = "user_id DESC, track_id DESC, date_key DESC, listen_duration DESC, device_type DESC"

_DAY = "strftime(max({}), '%Y-%m-%d %H:%M:%S')"

ORACLES = {
    "incr_extract": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{LAST}'",
    "incr_backfill": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{BACKFILL}'",
    "watermark_max": f"SELECT {_DAY.format('o_orderdate')} AS cdc FROM orders",
    "incr_all_tables": " UNION ALL ".join(
        [
            _landed("orders", "o_orderdate", _DAY.format("o_orderdate")),
            _landed("lineitem", "l_shipdate", _DAY.format("l_shipdate")),
            _landed("events", "ts", "rtrim(strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'), '0')"),
            _landed("customer", "c_custkey", "CAST(max(c_custkey) AS VARCHAR)"),
        ]
    ),
    "bronze_ingest": "SELECT *, 'events.parquet' AS file_name, true AS dated FROM events",
    # ties are settled by the fact's own columns in these two
    "silver_stream": f"""WITH {LINES}, plays AS (SELECT * FROM lines WHERE listen_duration > 0),
{scd1_sql(FACT_TIES)}""",
    "silver_facts_cut": f"""WITH {LINES}
SELECT stream_id, user_id, track_id, date_key, listen_duration, device_type, stream_timestamp, max_files
FROM lines, (VALUES (1), (1000)) AS cuts(max_files) WHERE listen_duration > 0
QUALIFY row_number() OVER (PARTITION BY stream_id, max_files ORDER BY stream_timestamp DESC, {FACT_TIES}) = 1""",
    "silver_users_cut": f"""WITH {USER_EVENTS},
newest AS (
  SELECT * FROM user_events
  WHERE length(user_name) > 0 AND country IS NOT NULL AND subscription_type IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id, updated_at
    ORDER BY user_name DESC, country DESC, subscription_type DESC) = 1),
marked AS (
  SELECT *, lag((user_name, country, subscription_type)) OVER (PARTITION BY user_id ORDER BY updated_at) AS before
  FROM newest),
opened AS (SELECT * FROM marked WHERE before IS NULL OR before IS DISTINCT FROM (user_name, country, subscription_type))
SELECT user_id, user_name, country, subscription_type, updated_at AS start_at,
       lead(updated_at) OVER (PARTITION BY user_id, max_files ORDER BY updated_at) AS end_at, max_files
FROM opened, (VALUES (1), (1000)) AS cuts(max_files)""",
    "silver_dims": f"""WITH {STAR}
SELECT 'artist' AS dimension, artist_id AS key, artist_sk::BIGINT AS number, artist_name AS name, true AS audited FROM artists
UNION ALL SELECT 'track', track_id, track_sk, track_name, true FROM tracks
UNION ALL SELECT 'date', date_key, date_key, weekday, true FROM dates""",
}
