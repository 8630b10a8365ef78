import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from listenlake.operators.sizes import measured_bytes
from listenlake.operators.star import (
    JoinSpec,
    hot_keys,
    left_join_salted,
    star_join,
)
from listenlake.plans import star as star_plan
from listenlake.plans.kpi import KPIS
from listenlake.plans.star import Star, base_fact
from listenlake.registry import gold as gold_queries
from listenlake.sources import sample


def test_an_unmatched_track_counts_as_completed(spark):
    star = sample.star(spark, SMALL)
    star.track = star.track.filter("track_id % 11 <> 0")
    wide = base_fact(star)
    assert wide.count() == star.fact.count()
    lost = wide.filter("track_id IS NULL")
    assert lost.count() > 0
    row = lost.groupBy().agg(
        F.max("is_meaningful_play").alias("flag"),
        F.collect_set("play_category").alias("labels"),
        F.count("duration_sec").alias("known"),
    ).first()
    assert row.flag == 0 and row.known == 0
    assert set(row.labels) == {"Abandoned", "Completed"}


def test_the_wide_view_has_all_columns_and_dims_can_be_left_out(spark):
    star = sample.star(spark, SMALL)
    assert len(base_fact(star).columns) == 26
    slim = base_fact(star, ["user"])
    assert "track_name" not in slim.columns and "year" not in slim.columns
    assert slim.count() == star.fact.count()
    with pytest.raises(ValueError):
        base_fact(star, ["album"])


def test_dimensions_are_unique(spark):
    star = sample.star(spark, SMALL)
    for dim, key in ((star.user, "user_id"), (star.track, "track_id"), (star.artist, "artist_id"), (star.date, "date_key")):
        assert dim.count() == dim.select(key).distinct().count()


def test_salting_changes_no_row(spark):
    rng = random.Random(4)
    keys = [7 if rng.random() < 0.4 else rng.randint(0, 30) for _ in range(2000)] + [None]
    fact = spark.createDataFrame(list(enumerate(keys)), "id long, k long")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 30, 2)] + [(7, "hot")], "dk long, name string")
    hot = hot_keys(fact, ["k"], 0.2)["k"]
    assert 7 in hot
    plain = fact.join(dim, F.col("k") == F.col("dk"), "left")
    salted = left_join_salted(fact, dim, "k", "dk", hot, ["id"], salts=5)
    assert salted.columns == plain.columns
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))
    assert left_join_salted(fact, dim, "k", "dk", [], ["id"]).count() == fact.count()


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark):
    def joins(limit):
        star = sample.star(spark, SMALL)
        star.broadcast_bytes = limit
        plan = base_fact(star, ["user", "track"])._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("strategy=broadcast"), plan.count("_salt")

    assert joins(1 << 20)[0] == 2
    broadcasts, _ = joins(0)
    assert broadcasts == 0


def test_measured_size(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a long, b string")
    assert measured_bytes(df) == 2 * 2 * 8 + 3
    assert measured_bytes(df.filter("a > 5")) == 0


def test_star_join_checks_its_specs(spark):
    df = spark.range(3).withColumnRenamed("id", "a")
    other = spark.range(1, 5).withColumnRenamed("id", "b")
    specs = [JoinSpec(df, "l", ["l.a"]), JoinSpec(other, "r", ["r.b"], "l.a = r.b")]
    assert sorted(tuple(r) for r in star_join(specs).fillna(-1).collect()) == [(0, -1), (1, 1), (2, 2)]
    with pytest.raises(ValueError):
        star_join([specs[1], specs[0]])


def _odd_star(spark, **sizes):
    """Missing keys, keys without a row, a user twice, missing plans and genres, a hot user."""
    rng = random.Random(9)
    plays = [(i, rng.choice([1, 1, 1, 2, 3, 4, 99, None]), rng.choice([10, 11, 12, 98, None]), 20240101, rng.choice([None, 0, 5, 40, 200]),
              rng.choice(["web", "car", None])) for i in range(600)]
    plays += [(None, 1, 10, None, 7, "web")]
    fact = spark.createDataFrame(plays, "stream_id long, user_id long, track_id long, date_key int, listen_duration int, device_type string")
    fact = fact.withColumn("unused", F.repeat(F.lit("x"), 20)).repartition(3)
    users = [(1, 1, "a", "DE", "free"), (2, 2, "b", "FR", "paid"), (2, 2, "b", "FR", "paid"), (3, 3, "c", None, None), (4, 4, "d", "FR", "free"), (5, None, "e", "DE", "free")]
    tracks = [(10, 10, "t", "x", 1, 100), (11, 11, "u", "x", 2, 50), (12, 12, None, "y", 3, None)]
    artists = [(1, 1, "p", "rock", "DE"), (2, 2, "q", "pop", "FR"), (3, 3, "r", None, "FR")]
    user = spark.createDataFrame(users, "user_sk long, user_id long, user_name string, country string, subscription_type string")
    track = spark.createDataFrame(tracks, "track_id long, track_sk long, track_name string, album_name string, artist_id long, duration_sec int")
    artist = spark.createDataFrame(artists, "artist_id long, artist_sk int, artist_name string, genre string, country string")
    date = spark.createDataFrame([(20240101, None, 1, 1, 2024, "Monday")], "date_key int, date date, day int, month int, year int, weekday string")
    return Star(lambda: fact, lambda: user, lambda: track, lambda: artist, lambda: date, **sizes)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_pass_finds_the_hot_keys_of_all_dimensions(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(star_plan, "hot_keys", lambda df, cols, share: asked.append(list(cols)) or hot_keys(df, cols, share))
    star = _odd_star(spark, broadcast_bytes=0, hot_share=0.1)
    salted = base_fact(star, ["user", "track", "artist"])
    plain = base_fact(_odd_star(spark), ["user", "track", "artist"])
    assert asked == [["user_id", "track_id"]]
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_a_salted_star_join_moves_no_columns_that_nobody_asks_for(spark):
    star = _odd_star(spark)

    def joined(**more):
        return star_join([
            JoinSpec(star.fact, "f", ["f.stream_id"], **more),
            JoinSpec(star.user, "u", ["u.user_name"], "u.user_id = f.user_id", ("user_id", "user_id")),
            JoinSpec(star.track, "t", ["t.track_name"], "t.track_id = f.track_id", ("track_id", "track_id")),
        ], 0.1)

    slim = joined(spread_by=["stream_id"])
    assert "repeat" not in _optimized(slim) and "unused" not in _optimized(slim)
    assert sorted(map(repr, slim.collect())) == sorted(map(repr, joined().collect()))


@pytest.mark.parametrize("name, dims, known", [
    ("genre_subscription_kpi", ["user", "track", "artist"], ["genre", "subscription_type"]),
    ("device_subscription_kpi", ["user"], ["device_type", "subscription_type"]),
])
def test_users_join_sums_per_user_rather_than_plays(spark, name, dims, known):
    star, kpi = _odd_star(spark), KPIS[name]
    plays = base_fact(star, dims).dropna(subset=known)
    sums = [c.alias(n) for n, c in kpi.sums().items()]
    want = kpi.finish(star, plays.groupBy(*kpi.keys).agg(*sums, F.countDistinct("user_id").alias("users")))
    found = kpi(star)
    assert found.dtypes == want.dtypes and found.count() > 1
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    plan = _optimized(found)
    assert plan.index("Join ") < plan.rindex("Aggregate [")


def test_a_refresh_reads_a_stored_fact(spark, monkeypatch):
    class Seen(Exception):
        pass

    def refresh(star, path_of):
        raise Seen(_optimized(star.fact))

    monkeypatch.setattr(gold_queries.gold, "refresh", refresh)
    with pytest.raises(Seen) as seen:
        gold_queries.gold_refresh(spark, SMALL)
    assert "Join" not in str(seen.value) and "stream_id" in str(seen.value)
