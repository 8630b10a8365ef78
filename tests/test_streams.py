"""All layers together: landing to gold."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from listenlake.operators.scd import current_only
from listenlake.plans import catalog, gold, views
from listenlake.plans.kpi import KPIS
from listenlake.plans.star import Star, base_fact
from listenlake.registry.history import user_events
from listenlake.sources import sample
from listenlake.sources.extract import SourceSpec, parquet_source
from listenlake.streaming import warehouse as warehouse_run
from listenlake.streaming.bronze import run_bronze
from listenlake.streaming.layout import Layout
from listenlake.streaming.silver import SilverLayer

TABLES = ["DimUser", "FactStream", "DimArtist", "DimTrack", "DimDate"]
PLANS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


def sources(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    return {
        "FactStream": sample.fact(spark, SMALL)
        .select(*sample.FACT_COLS)
        .withColumn("stream_timestamp", F.col("stream_timestamp").cast("timestamp")),
        "DimUser": user_events(spark, SMALL).drop("o_orderkey", "o_orderstatus"),
        "DimArtist": sample.artists(spark, SMALL).drop("artist_sk").withColumn("updated_at", at),
        "DimTrack": sample.tracks(spark, SMALL).drop("track_sk").withColumn("updated_at", at),
        "DimDate": sample.dates(spark, SMALL),
    }


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """Facts and users land in two steps; every step flows through to silver."""
    layout = Layout(str(tmp_path_factory.mktemp("warehouse")))
    layer = SilverLayer(spark, layout, plans=PLANS)
    tables = sources(spark)
    early = {
        "FactStream": F.col("stream_timestamp") < "1997-01-01",
        "DimUser": F.col("updated_at") < "1995-01-01",
    }
    for step in (0, 1):
        for name, df in tables.items():
            if name in early:
                df = df.filter(early[name] if step == 0 else ~early[name])
            elif step == 1:
                continue
            df.write.mode("append").parquet(layout.landing(name))
        run_bronze(spark, layout, TABLES)
        layer.run()
    return layout, layer


def star_of(layer) -> Star:
    return catalog.star_of(layer.users, layer.facts, layer.artists, layer.tracks, layer.dates)


def test_valid_and_logged_rows_make_up_the_input(spark, warehouse):
    layout, layer = warehouse
    bronze = spark.read.parquet(layout.bronze("FactStream"))
    log = spark.read.parquet(layout.quarantine()).filter("source_table = 'FactStream'")
    valid = bronze.filter("listen_duration > 0")
    assert log.count() == bronze.count() - valid.count() > 0
    assert layer.facts.read().count() == valid.select("stream_id").distinct().count()


def test_users_have_one_current_row_each(spark, warehouse):
    _, layer = warehouse
    users = layer.users.read()
    current = current_only(users)
    assert current.count() == users.select("user_id").distinct().count()
    newest = user_events(spark, SMALL).groupBy("user_id").agg(F.max("updated_at").alias("newest"))
    late = current.join(newest, "user_id").filter("updated_at > newest")
    assert late.count() == 0
    assert layer.users.head().facts["max_sk"] == users.count()


def test_running_again_changes_nothing(spark, warehouse):
    layout, layer = warehouse
    before = {n: t.head() for n, t in (("u", layer.users), ("f", layer.facts), ("a", layer.artists))}
    run_bronze(spark, layout, TABLES)
    layer.run()
    after = {n: t.head() for n, t in (("u", layer.users), ("f", layer.facts), ("a", layer.artists))}
    assert before == after


def test_a_rebuild_reads_all_of_bronze_again(spark, warehouse):
    layout, layer = warehouse
    again = SilverLayer(spark, Layout(layout.root, run="r1"), plans=PLANS, max_files=1000)
    again.run(["DimTrack", "DimDate"])
    for new, old in ((again.tracks, layer.tracks), (again.dates, layer.dates)):
        cols = [c for c in old.read().columns if "timestamp" not in c]
        assert new.read().select(cols).exceptAll(old.read().select(cols)).count() == 0
        assert new.read().count() == old.read().count()


def test_silver_dimensions_carry_keys_and_audit(spark, warehouse):
    _, layer = warehouse
    track = layer.tracks.read().first()
    assert track.track_sk == track.track_id and track.bronze_ingest_timestamp is not None
    artist = layer.artists.read().withColumn("want", F.hash("artist_id"))
    assert artist.filter("want <> artist_sk OR NOT dq_is_valid").count() == 0


def test_gold_adds_up_to_the_facts(spark, warehouse):
    layout, layer = warehouse
    star = star_of(layer)
    gold.refresh(star, layout.gold)
    stored = {name: gold.read_gold(spark, layout.gold(name)) for name in KPIS}
    assert all("gold_ingest_timestamp" in df.columns for df in stored.values())
    facts = layer.facts.read().count()
    for name in KPIS:
        assert stored[name].agg(F.sum("total_streams")).first()[0] == facts
    # facts that passed the rules were all listened to
    assert stored["user_engagement_kpi"].agg(F.sum("abandoned")).first()[0] == 0
    wide = base_fact(star)
    direct = wide.groupBy("year", "month").agg(F.count("stream_id").alias("n"))
    joined = stored["monthly_trend_kpi"].join(direct, ["year", "month"])
    assert joined.filter("n <> total_streams").count() == 0
    assert views.top_tracks(stored["top_tracks_kpi"]).count() >= 10
    growth = views.monthly_growth(stored["monthly_trend_kpi"]).collect()
    assert growth[0].prev_month_streams is None and growth[1].prev_month_streams is not None
    board = views.user_leaderboard(stored["user_engagement_kpi"])
    assert board.agg(F.max("rank_in_tier")).first()[0] <= 10
    views.genre_rank_in_plan(stored["genre_subscription_kpi"]).collect()
    views.device_rank_in_plan(stored["device_subscription_kpi"]).collect()


def test_one_run_takes_sources_to_sql_views(spark, tmp_path):
    def stored(name, df):
        df.write.parquet(f"{tmp_path}/source/{name}")
        return parquet_source(f"{tmp_path}/source/{name}")

    cdc_cols = {"FactStream": "stream_timestamp", "DimDate": "date"}
    specs = [
        SourceSpec(name, cdc_cols.get(name, "updated_at"), stored(name, df))
        for name, df in sources(spark).items()
    ]
    layout = Layout(f"{tmp_path}/warehouse")
    landed = warehouse_run.run(spark, layout, specs, plans=PLANS)
    assert all(step.rows > 0 for step in landed)
    facts = spark.sql("SELECT count(*) AS n FROM factstream").first().n
    assert spark.sql("SELECT count(*) AS n FROM vw_base_fact").first().n == facts > 0
    top = spark.sql("SELECT max(track_rank) AS r, count(*) AS n FROM cube_top10_tracks").first()
    assert top.r <= 10 <= top.n
    lookup = spark.sql("SELECT count(DISTINCT user_id) AS n FROM dimuser WHERE user_id = 20")
    assert lookup.first().n == 1
    for name in catalog.REPORTS:
        assert spark.table(name).count() > 0
    again = warehouse_run.run(spark, layout, specs, plans=PLANS)
    assert [step.rows for step in again] == [0] * len(specs)
    assert spark.sql("SELECT count(*) AS n FROM factstream").first().n == facts


def test_user_events_without_a_time_are_logged(spark, tmp_path):
    layout = Layout(str(tmp_path))
    rows = [(1, "Long name 1", None), (2, "Long name 2", "2024-01-02 00:00:00"), (None, "Long name 3", None)]
    events = spark.createDataFrame(rows, "user_id long, user_name string, at string").select(
        "user_id", "user_name", F.lit("DE").alias("country"), F.lit("Free").alias("subscription_type"),
        F.lit("2024-01-01").cast("date").alias("start_date"), F.col("at").cast("timestamp").alias("updated_at"),
    )
    events.write.parquet(layout.landing("DimUser"))
    run_bronze(spark, layout, ["DimUser"])
    layer = SilverLayer(spark, layout)
    layer.run(["DimUser", "DimUserHistory"])
    assert [r.user_id for r in layer.user_history.read().collect()] == [2]
    log = spark.read.parquet(layout.quarantine()).collect()
    assert sorted((r.source_table, r.natural_key, r.dq_fail_reason) for r in log) == [
        ("DimUser", None, "Missing user_id"), ("DimUserHistory", "1", "Missing updated_at"),
    ]


def test_a_rebuild_takes_in_all_of_bronze_again(spark, warehouse):
    layout, layer = warehouse
    before = layer.facts.read().select(*sample.FACT_COLS)
    fresh = warehouse_run.rebuild(spark, layout, PLANS, fact_grain="year")
    assert fresh.run == "r1" and fresh.next_run().run == "r2" and fresh.root == layout.root
    again = SilverLayer(spark, fresh)
    assert set(again.facts.head().parts) == {p[:4] for p in layer.facts.head().parts}
    for one, other in ((before, again.facts.read().select(*sample.FACT_COLS)), (layer.users.read(), again.users.read())):
        columns = [c for c in one.columns if not c.endswith(("_timestamp", "_sk"))]
        assert one.select(columns).exceptAll(other.select(columns)).isEmpty() and one.count() == other.count()
    # the KPI tables are of the new generation, and the old one is still there
    plays = gold.read_gold(spark, layout.gold("device_subscription_kpi")).agg(F.sum("total_streams")).first()[0]
    assert plays == again.facts.read().join(current_only(again.users.read()), "user_id").where("subscription_type IS NOT NULL").count()
    assert layer.facts.read().count() == before.count()
