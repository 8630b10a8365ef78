"""Gold queries: the wide view, the KPI tables and the reporting views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.functions import plays
from listenlake.operators.durable import materialise, scratch_path
from listenlake.operators.star import JoinSpec, star_join
from listenlake.plans import gold, kpi, rollup, views
from listenlake.plans.silver import fact_part
from listenlake.plans.star import base_fact
from listenlake.registry.sql import STAR, r2, r3
from listenlake.sources import sample
from listenlake.sources.snapshot import PART, SnapshotTable

# cuts near the middle of the sample's scores, so that every tier occurs
SAMPLE_TIER_CUTS = (("Platinum", 120), ("Gold", 90), ("Silver", 60))


def base_fact_view(spark, sf_dir) -> DataFrame:
    return base_fact(sample.star(spark, sf_dir))


def base_fact_salted(spark, sf_dir) -> DataFrame:
    """The path for dimensions too large to broadcast, with frequent keys salted."""
    star = sample.star(spark, sf_dir)
    star.broadcast_bytes, star.hot_share = 0, 0.001
    return base_fact(star)


def category_mix(spark, sf_dir) -> DataFrame:
    wide = base_fact(sample.star(spark, sf_dir), ["track"])
    return wide.groupBy("play_category", "is_meaningful_play").agg(F.count("*").alias("plays"))


def track_clean(spark, sf_dir) -> DataFrame:
    """Part sizes stretched to seconds so that all three duration buckets occur."""
    part = sample.table(spark, sf_dir, "part")
    seconds = F.col("p_size") * 10
    return part.select(
        F.col("p_partkey").alias("track_id"),
        plays.clean_name(F.concat_ws("-", "p_name", "p_type")).alias("track_name"),
        seconds.alias("duration_sec"),
        plays.duration_flag(seconds).alias("duration_flag"),
    )


def _star_join(spark, sf_dir, hot_share: float | None, users=None, tracks=None) -> DataFrame:
    star = sample.star(spark, sf_dir)
    return star_join(
        [
            JoinSpec(star.fact, "factstream", ["factstream.stream_id", "factstream.listen_duration"], spread_by=["stream_id"]),
            JoinSpec(
                star.user,
                "dimuser",
                ["dimuser.user_id", "dimuser.user_name"],
                "dimuser.user_id = factstream.user_id",
                users,
            ),
            JoinSpec(
                star.track,
                "dimtrack",
                ["dimtrack.track_id", "dimtrack.track_name"],
                "dimtrack.track_id = factstream.track_id",
                tracks,
            ),
        ],
        hot_share,
    )


def star_join_config(spark, sf_dir) -> DataFrame:
    return _star_join(spark, sf_dir, None)


def star_join_config_salted(spark, sf_dir) -> DataFrame:
    """The same with frequent and missing keys of both joins dealt over all partitions."""
    return _star_join(spark, sf_dir, 0.001, ("user_id", "user_id"), ("track_id", "track_id"))


def _kpi(build):
    return lambda spark, sf_dir: build(sample.star(spark, sf_dir))


def engagement_tiers(spark, sf_dir) -> DataFrame:
    scored = kpi.user_engagement_kpi(sample.star(spark, sf_dir), SAMPLE_TIER_CUTS)
    return scored.groupBy("subscription_type", "engagement_tier").agg(
        F.count("*").alias("users"), F.max("rank_in_tier").alias("last_rank")
    )


def _view(build, build_kpi):
    """A view over its KPI table, which is stored first, as in the gold layer."""

    def run(spark, sf_dir):
        return build(materialise(build_kpi(sample.star(spark, sf_dir)), "kpi"))

    return run


def top10_tracks(spark, sf_dir) -> DataFrame:
    return _view(views.top_tracks, kpi.top_tracks_kpi)(spark, sf_dir)


def gold_refresh(spark, sf_dir) -> DataFrame:
    """All KPI tables rewritten twice and read back: how many rows, over how many plays."""
    root = scratch_path(spark, "gold")
    # the fact is a stored table, as in the gold layer: it isn't put together anew for every table
    star = sample.star(spark, sf_dir, lambda fact: materialise(fact.drop(*sample.NOT_WIDE), "fact"))
    for _ in range(2):
        gold.refresh(star, lambda name: f"{root}/{name}")
    parts = [
        gold.read_gold(spark, f"{root}/{name}").agg(
            F.lit(name).alias("kpi"),
            F.count("*").alias("kpi_rows"),
            F.sum("total_streams").alias("plays"),
            F.count("gold_ingest_timestamp").alias("stamped"),
        )
        for name in kpi.KPIS
    ]
    return reduce(DataFrame.unionByName, parts)


PLAY_DDL = "stream_id bigint, user_id bigint, track_id bigint, date_key int, listen_duration int, device_type string"
# years in which plays come late, lie on a wrong day at first, and are put right
LATE, MOVED, WRONG = "1995", "1996", "1997"


def _kept(name: str):
    """The KPI table from kept sums, brought up to a fact that is published twice: first without some late plays of one
    year, and with some of another year under the next; then those parts are put right."""

    def run(spark, sf_dir):
        root, star = scratch_path(spark, "kept"), sample.star(spark, sf_dir)
        facts = SnapshotTable(spark, f"{root}/facts", PLAY_DDL)
        state = rollup.KpiState(spark, facts, star, f"{root}/state")
        year = F.col("date_key").cast("string").substr(1, 4)
        right = star.fact.select(*[F.col(f.name).cast(f.dataType) for f in facts.schema])
        late = (year == LATE) & (F.col("stream_id") % 10 == 0)
        moved = F.when((year == MOVED) & (F.col("stream_id") % 7 == 0), F.col("date_key") + 10_000).otherwise(F.col("date_key"))
        first = right.where(~late).withColumn("date_key", moved)
        facts.publish(first.withColumn(PART, fact_part("month")), 0)
        state.refresh([name])
        # plays moved to a day that isn't real, as from February 29, lie in the part of such days
        wrong = [p for p in facts.head().parts if p[:4] in (LATE, MOVED, WRONG) or p == "none"]
        again = right.withColumn(PART, fact_part("month")).where(year.isin(LATE, MOVED, WRONG) | (F.col(PART) == "none"))
        facts.publish(again, 1, replaces=wrong)
        state.refresh([name])
        return state.kpi(name)

    return run


QUERIES = {
    "base_fact": base_fact_view,
    "base_fact_salted": base_fact_salted,
    "category_mix": category_mix,
    "track_clean": track_clean,
    "star_join_config": star_join_config,
    "star_join_config_salted": star_join_config_salted,
    "genre_subscription_kpi": _kpi(kpi.genre_subscription_kpi),
    "top_tracks_kpi": _kpi(kpi.top_tracks_kpi),
    "device_subscription_kpi": _kpi(kpi.device_subscription_kpi),
    "monthly_trend_kpi": _kpi(kpi.monthly_trend_kpi),
    "user_engagement_kpi": _kpi(kpi.user_engagement_kpi),
    "engagement_tiers": engagement_tiers,
    "top10_tracks": top10_tracks,
    "genre_rank_in_plan": _view(views.genre_rank_in_plan, kpi.genre_subscription_kpi),
    "monthly_growth": _view(views.monthly_growth, kpi.monthly_trend_kpi),
    "device_rank_in_plan": _view(views.device_rank_in_plan, kpi.device_subscription_kpi),
    "user_leaderboard": _view(views.user_leaderboard, kpi.user_engagement_kpi),
    "gold_refresh": gold_refresh,
    **{f"{name}_kept": _kept(name) for name in kpi.KPIS},
}

_GENRE = f"""genre_kpi AS (
  SELECT genre, subscription_type, count(stream_id) AS total_streams,
         count(DISTINCT user_id) AS unique_users,
         {r2('avg(listen_duration)')} AS avg_listen_sec,
         count(*) FILTER (is_meaningful_play = 1) AS meaningful_plays,
         count(*) FILTER (play_category = 'Abandoned') AS abandoned_count,
         {r2("count(*) FILTER (is_meaningful_play = 1) / count(stream_id) * 100")}
           AS meaningful_play_rate_pct
  FROM base WHERE genre IS NOT NULL AND subscription_type IS NOT NULL
  GROUP BY genre, subscription_type)"""

_TRACKS = f"""tracks_kpi AS (
  SELECT track_id, track_name, artist_name, genre, count(stream_id) AS total_streams,
         count(DISTINCT user_id) AS unique_listeners,
         {r3('CAST(sum(listen_duration) AS BIGINT) / 3600')} AS total_listen_hrs,
         {r2('avg(listen_duration) / avg(duration_sec) * 100')} AS avg_completion_pct,
         {r2("count(*) FILTER (play_category = 'Skipped') / count(stream_id) * 100")}
           AS skip_rate_pct
  FROM base WHERE track_name IS NOT NULL
  GROUP BY track_id, track_name, artist_name, genre)"""

_DEVICE = f"""device_kpi AS (
  SELECT subscription_type, device_type, count(stream_id) AS total_streams,
         count(DISTINCT user_id) AS unique_users,
         {r2('avg(listen_duration)')} AS avg_listen_sec,
         {r2("count(*) FILTER (play_category = 'Abandoned') / count(stream_id) * 100")}
           AS abandon_rate_pct
  FROM base WHERE device_type IS NOT NULL AND subscription_type IS NOT NULL
  GROUP BY subscription_type, device_type)"""

_MONTHLY = f"""monthly_kpi AS (
  SELECT year, month, count(stream_id) AS total_streams,
         count(DISTINCT user_id) AS active_users,
         {r3('CAST(sum(listen_duration) AS BIGINT) / 3600')} AS total_listen_hrs,
         {r2('avg(listen_duration) / avg(duration_sec) * 100')} AS avg_completion_pct,
         {r2('count(stream_id) / count(DISTINCT user_id)')} AS streams_per_user
  FROM base WHERE year IS NOT NULL GROUP BY year, month)"""


def _users(cuts) -> str:
    tiers = " ".join(f"WHEN engagement_score >= {cut} THEN '{label}'" for label, cut in cuts)
    return f"""counted AS (
  SELECT user_sk, user_id, user_name, user_country, subscription_type,
         count(stream_id) AS total_streams,
         count(*) FILTER (is_meaningful_play = 1) AS meaningful_plays,
         count(*) FILTER (play_category = 'Abandoned') AS abandoned
  FROM base WHERE user_id IS NOT NULL GROUP BY ALL),
scored AS (
  SELECT *, meaningful_plays * 2 + total_streams - abandoned * 3 AS engagement_score FROM counted),
users_kpi AS (
  SELECT *, CASE {tiers} ELSE 'Bronze' END AS engagement_tier,
         CAST(rank() OVER (PARTITION BY subscription_type ORDER BY engagement_score DESC)
              AS INTEGER) AS rank_in_tier
  FROM scored)"""


_USERS = _users((("Platinum", 20), ("Gold", 10), ("Silver", 5)))


def _over(*ctes: str, select: str) -> str:
    return f"WITH {', '.join([STAR, *ctes])} {select}"


ORACLES = {
    "base_fact": _over(select="SELECT * FROM base"),
    "base_fact_salted": _over(select="SELECT * FROM base"),
    "category_mix": _over(
        select="SELECT play_category, is_meaningful_play, count(*) AS plays FROM base GROUP BY ALL"
    ),
    "track_clean": """
SELECT p_partkey AS track_id, replace(p_name || '-' || p_type, '-', '') AS track_name,
       p_size * 10 AS duration_sec,
       CASE WHEN p_size * 10 < 150 THEN 'low' WHEN p_size * 10 <= 300 THEN 'medium'
            ELSE 'high' END AS duration_flag
FROM part""",
    "star_join_config": _over(
        select="SELECT stream_id, listen_duration, user_id, user_name, track_id, track_name FROM base"
    ),
    "star_join_config_salted": _over(
        select="SELECT stream_id, listen_duration, user_id, user_name, track_id, track_name FROM base"
    ),
    "genre_subscription_kpi": _over(_GENRE, select="SELECT * FROM genre_kpi"),
    "top_tracks_kpi": _over(_TRACKS, select="SELECT * FROM tracks_kpi"),
    "device_subscription_kpi": _over(_DEVICE, select="SELECT * FROM device_kpi"),
    "monthly_trend_kpi": _over(_MONTHLY, select="SELECT * FROM monthly_kpi ORDER BY year, month"),
    "user_engagement_kpi": _over(_USERS, select="SELECT * FROM users_kpi"),
    "engagement_tiers": _over(
        _users(SAMPLE_TIER_CUTS),
        select="""SELECT subscription_type, engagement_tier, count(*) AS users,
                         max(rank_in_tier) AS last_rank
                  FROM users_kpi GROUP BY ALL""",
    ),
    "top10_tracks": _over(
        _TRACKS,
        select="""SELECT * EXCLUDE (track_id),
                         CAST(rank() OVER (ORDER BY total_listen_hrs DESC) AS INTEGER) AS track_rank
                  FROM tracks_kpi QUALIFY rank() OVER (ORDER BY total_listen_hrs DESC) <= 10""",
    ),
    "genre_rank_in_plan": _over(
        _GENRE,
        select="""SELECT genre, subscription_type, total_streams, unique_users,
                         meaningful_play_rate_pct,
                         CAST(rank() OVER (PARTITION BY subscription_type
                              ORDER BY total_streams DESC) AS INTEGER) AS genre_rank_in_plan
                  FROM genre_kpi""",
    ),
    "monthly_growth": _over(
        _MONTHLY,
        select=f"""SELECT year, month, total_streams, active_users, total_listen_hrs,
                          streams_per_user, prev_month_streams,
                          {r2('(total_streams - prev_month_streams) / prev_month_streams * 100')}
                            AS mom_growth_pct
                   FROM (SELECT *, lag(total_streams) OVER (ORDER BY year, month)
                                AS prev_month_streams FROM monthly_kpi)""",
    ),
    "device_rank_in_plan": _over(
        _DEVICE,
        select="""SELECT *, CAST(rank() OVER (PARTITION BY subscription_type
                              ORDER BY total_streams DESC) AS INTEGER) AS device_rank_in_plan
                  FROM device_kpi""",
    ),
    "user_leaderboard": _over(
        _USERS,
        select="""SELECT user_name, user_country, subscription_type, total_streams,
                         meaningful_plays, engagement_score, rank_in_tier
                  FROM users_kpi WHERE rank_in_tier <= 10""",
    ),
    "gold_refresh": _over(
        _GENRE,
        _TRACKS,
        _DEVICE,
        _MONTHLY,
        _USERS,
        select=" UNION ALL ".join(
            f"""SELECT '{name}' AS kpi, count(*) AS kpi_rows,
                       CAST(sum(total_streams) AS BIGINT) AS plays, count(*) AS stamped FROM {cte}"""
            for name, cte in (
                ("genre_subscription_kpi", "genre_kpi"),
                ("top_tracks_kpi", "tracks_kpi"),
                ("device_subscription_kpi", "device_kpi"),
                ("monthly_trend_kpi", "monthly_kpi"),
                ("user_engagement_kpi", "users_kpi"),
            )
        ),
    ),
}
ORACLES |= {f"{name}_kept": ORACLES[name] for name in kpi.KPIS}
