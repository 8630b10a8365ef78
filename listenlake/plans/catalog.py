"""Names under which SQL users find the tables and views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from listenlake.operators.scd import current_only
from listenlake.plans import gold, views
from listenlake.plans.kpi import KPIS
from listenlake.plans.star import Star, base_fact

# View names that existing SQL refers to.
CURRENT_USERS = "v_dimuser"
WIDE_FACT = "vw_base_fact"
REPORTS: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "cube_premium_vs_free_genre": (views.genre_rank_in_plan, "genre_subscription_kpi"),
    "cube_top10_tracks": (views.top_tracks, "top_tracks_kpi"),
    "cube_monthly_growth": (views.monthly_growth, "monthly_trend_kpi"),
    "cube_device_preference": (views.device_rank_in_plan, "device_subscription_kpi"),
    "cube_platinum_users": (views.user_leaderboard, "user_engagement_kpi"),
}


def star_of(users, facts, artists, tracks, dates, **options) -> Star:
    """The star over silver tables, users by their current version."""
    return Star(
        facts.read,
        lambda: current_only(users.read()),
        tracks.read,
        artists.read,
        dates.read,
        **options,
    )


def register_silver(spark: SparkSession, users, facts, artists, tracks, dates) -> Star:
    """Temporary views over the silver tables as committed now, and over their star."""
    star = star_of(users, facts, artists, tracks, dates)
    users.read().createOrReplaceTempView("dimuser")
    named = {
        CURRENT_USERS: star.user,
        "factstream": star.fact,
        "dimtrack": star.track,
        "dimartist": star.artist,
        "dimdate": star.date,
        WIDE_FACT: base_fact(star),
    }
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return star


def register_gold(spark: SparkSession, path_of: Callable[[str], str]) -> None:
    """Temporary views over the stored KPI tables and the reports on them."""
    stored = {name: gold.read_gold(spark, path_of(name)) for name in KPIS}
    for name, df in stored.items():
        df.createOrReplaceTempView(name)
    for name, (build, kpi) in REPORTS.items():
        build(stored[kpi]).createOrReplaceTempView(name)
