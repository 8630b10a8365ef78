import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from listenlake.operators.ranking import BAND_BITS, rank_in_group, top_with_ties


def test_rank_equals_the_window_rank(spark):
    rng = random.Random(1)
    span = 3 << BAND_BITS
    rows = [
        (i, rng.choice(["a", "b", None]), rng.choice([rng.randint(-span, span), 7, -1, 0]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id long, plan string, score long")
    want = F.rank().over(Window.partitionBy("plan").orderBy(F.col("score").desc()))
    both = rank_in_group(df, ["plan"], "score", "got").withColumn("want", want)
    assert both.count() == len(rows)
    assert both.filter("got <> want").count() == 0


def top(df, n):
    ranked = top_with_ties(df, n, "v", "place")
    return sorted((r.id, r.v, r.place) for r in ranked.collect())


def test_ties_at_the_border_all_stay(spark):
    rows = [(i, float(100 - i)) for i in range(9)] + [(9, 50.0), (10, 50.0), (11, 50.0), (12, 1.0)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = top(df, 10)
    assert [g[0] for g in got] == list(range(12))
    assert [g[2] for g in got] == [*range(1, 10), 10, 10, 10]


def test_ties_at_the_top_push_others_down(spark):
    rows = [(i, 5.0) for i in range(8)] + [(8, 4.0), (9, 3.0), (10, 3.0), (11, 2.0)]
    got = top(spark.createDataFrame(rows, "id long, v double"), 10)
    assert [g[2] for g in got] == [1] * 8 + [9, 10, 10]


def test_fewer_rows_than_asked_and_unknown_values(spark):
    got = top(spark.createDataFrame([(1, 2.0), (2, None), (3, None)], "id long, v double"), 10)
    assert [(g[0], g[2]) for g in got] == [(1, 1), (2, 2), (3, 2)]


def test_no_window_sees_a_whole_group(spark):
    df = spark.range(10).select(F.lit("a").alias("plan"), F.col("id").alias("score"))
    plan = rank_in_group(df, ["plan"], "score", "r")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    # one over bands, one inside a band; none over the rows themselves
    assert windows and all("_band" in line for line in windows)
