import random

from pyspark.sql import functions as F

from listenlake.operators.dedup import keep_latest
from listenlake.operators.keys import assign_sk


def test_numbers_are_dense_ordered_and_continue(spark):
    ids = random.Random(2).sample(range(10**9), 5000)
    df = spark.createDataFrame([(i,) for i in ids], "user_id long").repartition(7)
    numbered = assign_sk(df, ["user_id"], "user_sk", start=40)
    rows = sorted((r.user_id, r.user_sk) for r in numbered.collect())
    assert [r[1] for r in rows] == list(range(41, 5041))
    assert numbered.schema["user_sk"].dataType.simpleString() == "bigint"
    parts = df.orderBy("user_id").select(F.spark_partition_id()).distinct()
    assert parts.count() > 1


def test_no_rows_no_numbers(spark):
    assert assign_sk(spark.range(0), ["id"], "sk").count() == 0


def test_keep_latest_takes_the_tiebreak_and_puts_nulls_last(spark):
    rows = [(1, None, 9), (1, 5, 1), (1, 5, 2), (2, None, 1), (2, None, 3)]
    df = spark.createDataFrame(rows, "k long, at long, tie long")
    got = sorted(tuple(r) for r in keep_latest(df, ["k"], ["at"], ["tie"]).collect())
    assert got == [(1, 5, 2), (2, None, 3)]


def test_a_hot_key_is_thinned_before_the_shuffle(spark):
    df = spark.range(0, 20000, 1, 6).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    newest = keep_latest(df, ["k"], ["at"], [])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below
    assert sorted(r.at for r in newest.collect()) == [19998, 19999]
