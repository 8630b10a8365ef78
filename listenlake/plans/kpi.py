"""The five KPI tables.

Each joins only the dimensions its measures need, groups on keys, and attaches descriptive
columns afterwards where they depend on the key alone. All aggregates combine on the map side; a
distinct count adds the counted key to the first shuffle, so a hot group is spread by it.

A table is made in two steps: sums per group, which add up over any parts of the fact, and measures from
sums. So the sums may also be kept per part and be put together again (see ``rollup``).

Fixed values: the columns of the five tables, their keys among them, are what readers of the tables rely on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake import fixed
from listenlake.functions import measures as m
from listenlake.functions import plays
from listenlake.operators.ranking import rank_in_group
from listenlake.plans.star import Star, base_fact, tracks_with_artist

GOLD_TIMESTAMP = "gold_ingest_timestamp"
USERS = "users"


@dataclass(frozen=True)
class Kpi:
    """How a KPI table comes about.

    ``plays`` gives the fact rows that count, with extra fact columns if asked; ``sums`` are aggregates that add up;
    ``finish`` makes the table from keys, sums and, where ``distinct`` says so, the number of users per group.
    ``needs`` lists the dimension columns that keys and sums depend on. ``alone`` gives the plays without columns of
    the user, which then join sums per user, far fewer rows than plays.
    """

    plays: Callable[[Star, Sequence[str]], DataFrame]
    keys: tuple[str, ...]
    sums: Callable[[], Mapping[str, Column]]
    finish: Callable[[Star, DataFrame], DataFrame]
    needs: Mapping[str, tuple[str, ...]]
    distinct: bool = True
    alone: Callable[[Star], DataFrame] | None = None

    def __call__(self, star: Star) -> DataFrame:
        if self.alone:
            plays, sums = self._per_user(star), {name: F.sum(name) for name in self.sums()}
        else:
            plays, sums = self.plays(star, ()), self.sums()
        aggregates = [c.alias(name) for name, c in sums.items()]
        if self.distinct:
            aggregates.append(F.countDistinct("user_id").alias(USERS))
        return self.finish(star, plays.groupBy(*self.keys).agg(*aggregates))

    def _per_user(self, star: Star) -> DataFrame:
        """Sums per user and those keys that aren't columns of the user, joined by the others."""
        own = [k for k in self.keys if k in self.needs["user"]]
        keys = ["user_id", *[k for k in self.keys if k not in own]]
        sums = self.alone(star).dropna(subset=keys).groupBy(*keys).agg(*[c.alias(n) for n, c in self.sums().items()])
        return sums.join(star.user.select("user_id", *own).dropna(), "user_id")


def _abandoned() -> Column:
    return m.flagged(plays.is_abandoned(F.col("listen_duration")))


def _meaningful() -> Column:
    return m.flagged(F.col("is_meaningful_play") == 1)


def _listening(*dims: str) -> dict[str, Column]:
    """Sums and counts of what averages are taken of."""
    cols = {"listen": "listen_duration", **({"duration": "duration_sec"} if "track" in dims else {})}
    return {f"{n}_sum": F.sum(c) for n, c in cols.items()} | {f"{n}_count": F.count(c) for n, c in cols.items()}


def _average(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_count"))


def _known(dims: Sequence[str], columns: Sequence[str], star: Star, extra: Sequence[str]) -> DataFrame:
    return base_fact(star, dims, extra).dropna(subset=list(columns))


def _genre(star: Star, sums: DataFrame) -> DataFrame:
    return sums.select(
        "genre",
        "subscription_type",
        "total_streams",
        F.col(USERS).alias("unique_users"),
        F.round(_average("listen"), 2).alias("avg_listen_sec"),
        "meaningful_plays",
        "abandoned_count",
        m.percent(F.col("meaningful_plays"), F.col("total_streams")).alias("meaningful_play_rate_pct"),
    )


# Engagement per genre and plan.
genre_subscription_kpi = Kpi(
    partial(_known, ["user", "track", "artist"], ["genre", "subscription_type"]),
    ("genre", "subscription_type"),
    lambda: {
        "total_streams": F.count("stream_id"), **_listening(), "meaningful_plays": _meaningful(), "abandoned_count": _abandoned(),
    },
    _genre,
    {"user": ("user_id", "subscription_type"), "track": ("track_id", "artist_id", "duration_sec"), "artist": ("artist_id", "genre")},
    alone=lambda star: base_fact(star, ["track", "artist"]),
)


def _tracks(star: Star, sums: DataFrame) -> DataFrame:
    """Names, artist and genre join the grouped rows, not the plays."""
    per_track = sums.select(
        "track_id",
        "total_streams",
        F.col(USERS).alias("unique_listeners"),
        F.round(F.col("listen_sum") / m.SECONDS_PER_HOUR, 3).alias("total_listen_hrs"),
        m.percent(_average("listen"), _average("duration")).alias("avg_completion_pct"),
        m.percent(F.col("skipped"), F.col("total_streams")).alias("skip_rate_pct"),
    )
    names = tracks_with_artist(star).select(
        F.col("t_track_id").alias("track_id"),
        F.col("t_track_name").alias("track_name"),
        F.col("a_artist_name").alias("artist_name"),
        F.col("a_genre").alias("genre"),
    )
    return per_track.join(names, "track_id").select(
        "track_id", "track_name", "artist_name", "genre", *per_track.columns[1:]
    )


# Listening per track.
top_tracks_kpi = Kpi(
    partial(_known, ["track"], ["track_name"]),
    ("track_id",),
    lambda: {
        "total_streams": F.count("stream_id"), **_listening("track"),
        "skipped": m.flagged(plays.is_skipped(F.col("listen_duration"), F.col("duration_sec"))),
    },
    _tracks,
    {"track": ("track_id", "track_name", "duration_sec")},
)


def _device(star: Star, sums: DataFrame) -> DataFrame:
    return sums.select(
        "subscription_type",
        "device_type",
        "total_streams",
        F.col(USERS).alias("unique_users"),
        F.round(_average("listen"), 2).alias("avg_listen_sec"),
        m.percent(F.col("abandoned"), F.col("total_streams")).alias("abandon_rate_pct"),
    )


# Usage per plan and device. An abandoned play needs no track, so only users are joined.
device_subscription_kpi = Kpi(
    partial(_known, ["user"], ["device_type", "subscription_type"]),
    ("subscription_type", "device_type"),
    lambda: {"total_streams": F.count("stream_id"), **_listening(), "abandoned": _abandoned()},
    _device,
    {"user": ("user_id", "subscription_type")},
    alone=lambda star: base_fact(star, []),
)


def _months(star: Star, sums: DataFrame) -> DataFrame:
    return sums.select(
        "year",
        "month",
        "total_streams",
        F.col(USERS).alias("active_users"),
        F.round(F.col("listen_sum") / m.SECONDS_PER_HOUR, 3).alias("total_listen_hrs"),
        m.percent(_average("listen"), _average("duration")).alias("avg_completion_pct"),
        F.round(F.try_divide(F.col("total_streams"), F.col(USERS)), 2).alias("streams_per_user"),
    ).orderBy("year", "month")


# Activity per calendar month, in calendar order.
monthly_trend_kpi = Kpi(
    partial(_known, ["track", "date"], ["year"]),
    ("year", "month"),
    lambda: {"total_streams": F.count("stream_id"), **_listening("track")},
    _months,
    {"track": ("track_id", "duration_sec"), "date": ("date_key", "year", "month")},
)


def _users(star: Star, per_user: DataFrame, cuts=fixed.TIER_CUTS, floor: str = fixed.TIER_FLOOR) -> DataFrame:
    """Score card per user: counts, score, tier and rank inside the plan.

    Plays are grouped by user key before the user table is joined, so that join moves one row
    per user. ``rank_in_tier`` ranks inside the plan, as readers of the table expect of it.
    """
    names = star.user.select(
        "user_sk",
        F.col("user_id").alias("_user_id"),
        "user_name",
        F.col("country").alias("user_country"),
        "subscription_type",
    )
    score = (
        fixed.MEANINGFUL_WEIGHT * F.col("meaningful_plays")
        + F.col("total_streams")
        - fixed.ABANDONED_WEIGHT * F.col("abandoned")
    )
    scored = (
        per_user.join(names, F.col("user_id") == F.col("_user_id"), "left")
        .withColumn("engagement_score", score)
        .withColumn("engagement_tier", plays.tier(F.col("engagement_score"), cuts, floor))
        .select(
            "user_sk",
            "user_id",
            "user_name",
            "user_country",
            "subscription_type",
            "total_streams",
            "meaningful_plays",
            "abandoned",
            "engagement_score",
            "engagement_tier",
        )
    )
    return rank_in_group(scored, ["subscription_type"], "engagement_score", "rank_in_tier")


engagement = Kpi(
    partial(_known, ["track"], ["user_id"]),
    ("user_id",),
    lambda: {"total_streams": F.count("stream_id"), "meaningful_plays": _meaningful(), "abandoned": _abandoned()},
    _users,
    {"track": ("track_id", "duration_sec")},
    distinct=False,
)


def user_engagement_kpi(star: Star, cuts=fixed.TIER_CUTS, floor: str = fixed.TIER_FLOOR) -> DataFrame:
    return replace(engagement, finish=partial(_users, cuts=cuts, floor=floor))(star)


KPIS = {
    "genre_subscription_kpi": genre_subscription_kpi,
    "top_tracks_kpi": top_tracks_kpi,
    "device_subscription_kpi": device_subscription_kpi,
    "monthly_trend_kpi": monthly_trend_kpi,
    "user_engagement_kpi": engagement,
}


def stamp(kpi: DataFrame) -> DataFrame:
    return kpi.withColumn(GOLD_TIMESTAMP, F.current_timestamp())
