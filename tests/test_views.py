from pyspark.sql import functions as F

from listenlake.plans import views


def test_growth_of_first_month_and_after_an_empty_one(spark):
    rows = [(2024, 1, 0), (2024, 2, 10), (2023, 12, 4), (2024, 3, 15)]
    kpi = spark.createDataFrame(rows, "year int, month int, total_streams long").withColumns(
        {"active_users": F.lit(1), "total_listen_hrs": F.lit(1.0), "streams_per_user": F.lit(1.0)}
    )
    got = [(r.month, r.prev_month_streams, r.mom_growth_pct) for r in views.monthly_growth(kpi).collect()]
    assert got == [(12, None, None), (1, 4, -100.0), (2, 0, None), (3, 10, 50.0)]


def test_leaderboard_is_best_first(spark):
    rows = [("a", 5, 1), ("b", 9, 2), ("c", 1, 10), ("d", 0, 11)]
    kpi = spark.createDataFrame(rows, "user_name string, engagement_score long, rank_in_tier int")
    kpi = kpi.withColumns(
        {c: F.lit(1) for c in ("user_country", "subscription_type", "total_streams", "meaningful_plays")}
    )
    assert [r.user_name for r in views.user_leaderboard(kpi).collect()] == ["b", "a", "c"]
