from fractions import Fraction

from pyspark.sql import functions as F

from listenlake.functions import measures, plays


def label(listen, duration):
    if listen is None or listen == 0:
        return "Abandoned"
    if duration is None:
        return "Completed"
    if listen < duration * Fraction(1, 5):
        return "Skipped"
    if listen < duration * Fraction(1, 2):
        return "partial"
    return "Completed"


def test_every_small_pair_is_labelled_exactly(spark):
    values = [None, *range(0, 41)]
    df = spark.createDataFrame([(a, b) for a in values for b in values], "listen int, duration int")
    listen, duration = F.col("listen"), F.col("duration")
    rows = df.select(
        "listen",
        "duration",
        plays.play_category(listen, duration).alias("category"),
        plays.is_meaningful_play(listen, duration).alias("meaningful"),
        plays.is_skipped(listen, duration).alias("skipped"),
        plays.is_abandoned(listen).alias("abandoned"),
    ).collect()
    for r in rows:
        known = r.listen is not None and r.duration is not None
        assert r.category == label(r.listen, r.duration)
        assert r.meaningful == int(known and r.listen >= r.duration * Fraction(1, 5))
        assert r.skipped == (r.category == "Skipped")
        assert r.abandoned == (r.category == "Abandoned")


def test_tiers_and_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (-7, 4, 5, 9, 10, 19, 20, 500)], "n int")
    tiers = [r[0] for r in df.select(plays.tier(F.col("n"))).collect()]
    assert tiers == [
        "Bronze", "Bronze", "Silver", "Silver", "Gold", "Gold", "Platinum", "Platinum"
    ]
    seconds = spark.createDataFrame([(n,) for n in (149, 150, 300, 301)], "n int")
    flags = [r[0] for r in seconds.select(plays.duration_flag(F.col("n"))).collect()]
    assert flags == ["low", "medium", "medium", "high"]


def test_percent_of_nothing_is_null(spark):
    df = spark.range(1).select(measures.percent(F.lit(1), F.lit(0)).alias("p"))
    assert df.first().p is None
