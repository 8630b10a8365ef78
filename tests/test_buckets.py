"""Buckets that grow with a table, and filters of the keys of a part: what a batch reads and rewrites."""

import datetime as dt
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listenlake.plans import silver
from listenlake.sources.buckets import BUCKETS, ROWS, bucket, parents
from listenlake.sources.partfilters import part_filters, parts_that_may_hold
from listenlake.sources.snapshot import PART, SnapshotTable


@given(st.integers(1, 300), st.integers(0, 40), st.lists(st.integers(0, 2**40), min_size=1, max_size=50))
def test_only_keys_of_the_parents_move(count, more, hashes):
    def place(h, n):
        low = 1 << (n.bit_length() - 1)
        wide = h % (2 * low)
        return wide if wide < n else wide - low

    for h in hashes:
        old, new = place(h, count), place(h, count + more)
        assert 0 <= old < count and 0 <= new < count + more
        assert new == old or old in parents(count, count + more)
    assert len(parents(count, count + more)) <= more


def test_spark_places_keys_in_all_buckets_alike(spark):
    for n in (1, 2, 3, 5, 8, 13):
        sizes = [r["count"] for r in spark.range(13_000).groupBy(bucket(["id"], n).alias("b")).count().orderBy("b").collect()]
        assert len(sizes) == n and max(sizes) < 2.6 * 13_000 / n


def test_a_filter_never_refuses_a_key_it_has(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") < 20_000, "a").when(F.col("id") < 20_010, "b").otherwise("c").alias(PART))
    filters = part_filters(rows, "id").cache()
    assert filters.groupBy(PART).agg(F.max("blocks").alias("n")).where("n > 1").count() == 2
    for ids, parts in (([5], {"a"}), ([20_005, 29_999], {"b", "c"}), (range(0, 30_000, 100), {"a", "b", "c"}), ([], set())):
        keys = spark.createDataFrame([(i,) for i in ids], "id long")
        assert parts <= set(parts_that_may_hold(filters, keys, "id"))
    strange = [spark.createDataFrame([(1_000_000 + i,)], "id long") for i in range(8)]
    assert sum(len(parts_that_may_hold(filters, keys, "id")) for keys in strange) <= 2


STAMP = dt.datetime(2024, 1, 1)
AUDIT = "bronze_ingest_timestamp timestamp, input_file_path string, ingest_timestamp timestamp"


def users(spark, rows):
    ddl = "user_id long, user_name string, country string, subscription_type string, start_date date, updated_at timestamp"
    full = [(i, f"name {i}", c, "Free", dt.date(2024, 1, 1) + dt.timedelta(at), STAMP + dt.timedelta(at)) for i, c, at in rows]
    return with_audit(spark.createDataFrame(full, ddl))


def with_audit(df):
    return df.select("*", F.lit(STAMP).alias("ingest_timestamp"), F.lit("f").alias("input_file_path"))


def content(table, columns):
    return sorted(map(repr, table.read().select(columns).collect()))


USER = ["user_id", "user_name", "country", "subscription_type", "scd_start_date", "scd_end_date", "is_current"]


def changed_parts(before, after):
    return {p for p in before.parts if after.parts.get(p) != before.parts[p]}


def test_a_user_batch_rewrites_its_buckets_only_and_equals_the_full_merge(spark, root):
    small, whole = (SnapshotTable(spark, f"{root}/{n}", silver.USER_DDL) for n in ("small", "whole"))
    draw, log = random.Random(3), f"{root}/dqm"
    batches = [[(i, "NL", 0) for i in range(400)], [(i, draw.choice(["NL", "BE"]), 1) for i in draw.sample(range(500), 12)]]
    batches += [[(i, draw.choice(["NL", "BE", "DE"]), n) for i in draw.sample(range(400 + 60 * n), 40)] for n in (2, 3)]
    batches += [[(None, "BE", 4), (7, "FR", 4)]]
    for n, batch in enumerate(batches):
        before = small.head()
        for table, per_bucket in ((small, 10), (whole, 10**9)):
            silver.apply_user_batch(users(spark, batch), n, table, log, per_bucket=per_bucket)
        after = small.head()
        current = {p for p in changed_parts(before, after) if p != silver.USER_HISTORY}
        due = after.facts[BUCKETS] - before.facts.get(BUCKETS, after.facts[BUCKETS])
        assert len(current) <= len(batch) + due
        assert after.facts[ROWS] == small.read().where("is_current").count()
    assert after.facts[BUCKETS] >= 40 and whole.head().facts[BUCKETS] == 1
    assert content(small, USER) == content(whole, USER)
    assert len({r.user_sk for r in small.read().collect()}) == small.read().count() == after.facts["max_sk"]


HISTORY = ["user_id", "country", "updated_at", "start_at", "end_at", "opens_version"]


@pytest.mark.parametrize("seed", [1, 2])
def test_histories_are_the_same_in_any_number_of_buckets(spark, root, seed):
    draw = random.Random(seed)
    events = [(draw.randrange(60), draw.choice(["NL", "BE"]), draw.randrange(50)) for _ in range(240)]
    tables = []
    for name, per_bucket, cuts in (("a", 7, 4), ("b", 10**9, 1), ("c", 20, 3)):
        table = SnapshotTable(spark, f"{root}/{name}", silver.USER_HISTORY_DDL)
        mixed = draw.sample(events, len(events))
        for n in range(cuts):
            silver.apply_user_history_batch(users(spark, mixed[n::cuts]), n, table, f"{root}/dqm", per_bucket=per_bucket)
        assert table.head().facts[ROWS] == table.read().count()
        tables.append(content(table, HISTORY))
    assert tables[0] == tables[1] == tables[2]


def test_a_dimension_batch_rewrites_its_buckets_only(spark, root):
    ddl = "track_id long, track_name string, album_name string, artist_id long, duration_sec int, updated_at timestamp"
    table = SnapshotTable(spark, root, silver.TRACK_DDL)
    latest = {}
    for n, ids in enumerate((range(300), [5, 6, 7], range(290, 420), [1, 419, None])):
        rows = [(i, f"t{i}v{n}", "a", 1, n, STAMP + dt.timedelta(n)) for i in ids]
        latest |= {r[0]: r[1] for r in rows}
        before = table.head()
        silver.apply_dimension_batch(
            with_audit(spark.createDataFrame(rows, ddl)), n, table, silver.stage_tracks, "track_id", "updated_at", per_bucket=20
        )
        after = table.head()
        due = after.facts[BUCKETS] - before.facts.get(BUCKETS, after.facts[BUCKETS])
        assert len(changed_parts(before, after)) <= len(rows) + due
    assert {r.track_id: r.track_name for r in table.read().collect()} == latest
    assert after.facts[ROWS] == len(latest) and after.facts[BUCKETS] > 15


def test_a_table_of_the_earlier_layout_is_taken_in(spark, root):
    table = SnapshotTable(spark, root, silver.TRACK_DDL)
    ddl = "track_id long, track_name string, album_name string, artist_id long, duration_sec int, updated_at timestamp"

    def batch(ids, name):
        return with_audit(spark.createDataFrame([(i, name, "a", 1, 1, STAMP) for i in ids], ddl))

    old = silver.stage_tracks(batch(range(50), "old")).select(*table.schema.names).withColumn(PART, F.lit("all"))
    table.publish(old, 0)
    silver.apply_dimension_batch(batch([3, 99], "new"), 1, table, silver.stage_tracks, "track_id", "updated_at", per_bucket=10)
    head = table.head()
    assert "all" not in head.parts and head.facts == {BUCKETS: 6, ROWS: 51}
    assert {r.track_id for r in table.read().where("track_name = 'new'").collect()} == {3, 99}


def facts(spark, rows):
    ddl = "stream_id long, user_id long, track_id long, date_key int, listen_duration int, device_type string, stream_timestamp timestamp"
    full = [(i, 1, 1, day, n, "tv", STAMP + dt.timedelta(hours=n)) for i, day, n in rows]
    return with_audit(spark.createDataFrame(full, ddl))


def test_a_small_fact_batch_looks_into_few_parts(spark, root):
    table = SnapshotTable(spark, root, silver.FACT_DDL, "stream_id")
    plain = SnapshotTable(spark, f"{root}/plain", silver.FACT_DDL)
    months = [20240101 + 100 * m for m in range(12)]
    first = [(i, months[i % 12], 1) for i in range(6_000)]
    moved = [(24, months[5], 2), (25, months[1], 3), (10_000, 99999999, 1)]
    opened = []
    read = table.read
    table.read = lambda parts=None, head=None: opened.append(None if parts is None else set(parts)) or read(parts, head)
    for n, rows in enumerate((first, moved, [(10_000, months[3], 5)])):
        for t in (table, plain):
            silver.apply_fact_batch(facts(spark, rows), n, t, f"{root}/dqm", guard="stream_timestamp")
    # the look-up of the second batch, and what it rewrites: where 24 and 25 lay, and where they go
    looked, merged = opened[-4], opened[-3]
    assert {"202401", "202402"} <= looked and len(looked) <= 6
    assert merged == {"202401", "202402", "202406", "none"}
    columns = ["stream_id", "date_key", "listen_duration"]
    assert content(table, columns) == content(plain, columns)
    # an empty part goes, and filters are vacuumed with the data
    assert set(table.head().filters) == set(table.head().parts) and "none" not in table.head().parts
    assert {path.split("/")[0] for path in table.vacuum(1)} == {"data", "filters"}
    assert content(table, columns) == content(plain, columns)
