import datetime as dt
import random

import pytest

from listenlake.operators.dedup import keep_latest
from listenlake.operators.scd import current_only, scd1_merge
from listenlake.plans import silver
from listenlake.sources.snapshot import SnapshotTable

FACT = "stream_id long, user_id long, date_key int, listen_duration int, device_type string, at int"
UPDATES = ("date_key", "listen_duration", "device_type")


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_scd1_updates_some_columns_and_adds_rows(spark):
    target = facts(spark, [(1, 10, 20240101, 5, "web", 1), (2, 20, 20240101, 6, "web", 1)])
    source = facts(spark, [(2, 99, 20240301, None, "tv", 3), (3, 30, 20240302, 8, "tv", 3)])
    for small in (False, True):
        merged = scd1_merge(target, source, ["stream_id"], UPDATES, small=small)
        assert merged.columns == target.columns
        got = sorted(tuple(r) for r in merged.collect())
        assert got == [
            (1, 10, 20240101, 5, "web", 1),
            (2, 20, 20240301, None, "tv", 1),
            (3, 30, 20240302, 8, "tv", 3),
        ]
        again = scd1_merge(merged, source, ["stream_id"], UPDATES, small=small)
        assert sorted(tuple(r) for r in again.collect()) == got


def test_a_small_source_does_not_shuffle_the_target(spark):
    target = facts(spark, [(1, 10, 20240101, 5, "web", 1)])
    source = facts(spark, [(2, 99, 20240301, None, "tv", 3)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {
            small: scd1_merge(target, source, ["stream_id"], UPDATES, small=small)
            ._jdf.queryExecution()
            .executedPlan()
            .toString()
            for small in (False, True)
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in plans[False] and "BroadcastHashJoin" not in plans[False]
    assert plans[True].count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("target_at, wins", [(5, False), (3, True), (1, True), (None, True)])
def test_scd1_guard_refuses_older_events(spark, target_at, wins, small):
    target = facts(spark, [(1, 10, 1, 5, "web", target_at)])
    source = facts(spark, [(1, 10, 2, 6, "tv", 3), (2, 20, 2, 6, "tv", None)])
    merged = scd1_merge(target, source, ["stream_id"], UPDATES, "at", small).orderBy("stream_id")
    old, new = merged.collect()
    assert (old.device_type == "tv") == wins and new.user_id == 20


USER = (
    "user_id long, user_name string, country string, subscription_type string, "
    "start_date date, updated_at timestamp, ingest_timestamp timestamp, input_file_path string"
)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def user(uid, plan, n, name="alice", country="NO", start=True):
    at = dt.datetime.combine(day(n), dt.time())
    return (uid, name, country, plan, day(n) if start else None, at, at, "f.parquet")


def simulate(batches):
    """The merge as plain loops over lists."""
    table = []
    for batch in batches:
        newest = {}
        for row in batch:
            if row[0] not in newest or row[5] > newest[row[0]][5]:
                newest[row[0]] = row
        sk = len(table)
        for uid in sorted(newest):
            row = newest[uid]
            now = next((t for t in table if t["id"] == uid and t["end"] is None), None)
            if now and now["plan"] == row[3]:
                continue
            if now:
                now["end"] = row[4]
            sk += 1
            table.append({"sk": sk, "id": uid, "plan": row[3], "start": row[4], "end": None})
    return sorted((t["sk"], t["id"], t["plan"], t["start"], t["end"]) for t in table)


@pytest.fixture(params=["broadcast", "shuffled"])
def source_size(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(silver, "fits_broadcast", lambda df: False)


def load(spark, root, batches, **kwargs):
    users = SnapshotTable(spark, f"{root}/users", silver.USER_DDL)
    for i, batch in enumerate(batches):
        silver.apply_user_batch(
            spark.createDataFrame(batch, USER), i, users, f"{root}/log", **kwargs
        )
    return users


def state(users):
    return sorted(
        (r.user_sk, r.user_id, r.subscription_type, r.scd_start_date, r.scd_end_date)
        for r in users.read().collect()
    )


def test_scd2_equals_a_simulation_and_keeps_its_invariants(spark, root, source_size):
    rng = random.Random(3)
    batches = []
    for b in range(3):
        days = rng.sample(range(b * 100, b * 100 + 100), 60)
        batches.append(
            [user(rng.randint(1, 25), rng.choice(["Free", "Premium", "Family"]), d) for d in days]
        )
    users = load(spark, root, batches)
    assert state(users) == simulate(batches)

    rows = users.read().collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_id, []).append(r)
    for versions in by_user.values():
        versions.sort(key=lambda r: r.scd_start_date)
        assert [v.is_current for v in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a.scd_end_date == b.scd_start_date for a, b in zip(versions, versions[1:]))
        assert all(a.subscription_type != b.subscription_type for a, b in zip(versions, versions[1:]))
    assert sorted(r.user_sk for r in rows) == list(range(1, len(rows) + 1))
    assert current_only(users.read()).count() == len(by_user)


def test_replayed_and_older_batches_change_nothing(spark, root):
    batches = [[user(1, "Free", 0)], [user(1, "Premium", 5), user(2, "Free", 5)]]
    users = load(spark, root, batches)
    before = state(users)
    for i in (0, 1):
        silver.apply_user_batch(
            spark.createDataFrame(batches[i], USER), i, users, f"{root}/log"
        )
    assert state(users) == before


def test_only_the_newest_version_of_a_batch_survives(spark, root):
    users = load(spark, root, [[user(1, "Free", 0), user(1, "Family", 2), user(1, "Premium", 1)]])
    assert [s[2:] for s in state(users)] == [("Family", day(2), None)]


def test_numbers_with_gaps_on_request(spark, root):
    batches = [
        [user(1, "Free", 0), user(2, "Free", 0), user(3, "Free", 0)],
        [user(1, "Free", 5), user(2, "Family", 5), user(3, "Free", 5)],
        [user(4, "Free", 6)],
    ]
    gaps = load(spark, f"{root}/a", batches, gap_free=False)
    assert [s[:3] for s in state(gaps)] == [
        (1, 1, "Free"), (2, 2, "Free"), (3, 3, "Free"), (5, 2, "Family"), (6, 4, "Free")
    ]
    dense = load(spark, f"{root}/b", batches)
    assert [s[0] for s in state(dense)] == [1, 2, 3, 4, 5]


def test_a_missing_start_falls_back_to_the_update_day(spark, root):
    users = load(spark, root, [[user(1, "Free", 0)], [user(1, "Premium", 4, start=False)]])
    assert [s[2:] for s in state(users)] == [
        ("Free", day(0), day(4)),
        ("Premium", day(4), None),
    ]


def test_late_batch_overwrites_unless_guarded(spark, root):
    batches = [[user(1, "Free", 9)], [user(1, "Premium", 3)]]
    assert len(state(load(spark, f"{root}/a", batches))) == 2
    assert [s[2] for s in state(load(spark, f"{root}/b", batches, guard="updated_at"))] == ["Free"]


def test_invalid_users_are_logged_and_soft_failures_pass(spark, root):
    users = load(spark, root, [[user(1, "Free", 0, country=None), user(2, "Odd", 0, name="al")]])
    assert [s[1] for s in state(users)] == [2]
    log = spark.read.parquet(f"{root}/log").collect()
    assert [(r.natural_key, r.dq_fail_reason) for r in log] == [("1", "Missing country")]


def test_a_batch_without_valid_rows_commits_nothing(spark, root):
    users = load(spark, root, [[user(1, "Free", 0, country=None)]])
    assert users.head().version == 0 and users.read().count() == 0


PLAY = (
    "stream_id long, user_id long, track_id long, date_key int, listen_duration int, "
    "device_type string, stream_timestamp timestamp, ingest_timestamp timestamp, "
    "input_file_path string"
)


def play(sid, date_key, listen, device="web", hour=0):
    at = dt.datetime(2024, 1, 1, hour)
    return (sid, 1, 1, date_key, listen, device, at, at, "f.parquet")


def test_fact_batches_move_rows_between_months(spark, root, source_size):
    facts_table = SnapshotTable(spark, f"{root}/facts", silver.FACT_DDL)
    batches = [
        [play(1, 20240105, 5), play(2, 20240106, 6), play(3, 20240210, 7), play(4, 20240301, 0)],
        [play(3, 20240120, 8, "tv"), play(5, 20240401, 9), play(5, 20240402, 10, hour=3)],
    ]
    for i, batch in enumerate(batches):
        silver.apply_fact_batch(
            spark.createDataFrame(batch, PLAY), i, facts_table, f"{root}/log"
        )
    got = sorted((r.stream_id, r.date_key, r.listen_duration) for r in facts_table.read().collect())
    assert got == [(1, 20240105, 5), (2, 20240106, 6), (3, 20240120, 8), (5, 20240402, 10)]
    # February lost its only row, so it has no folder any more
    assert sorted(facts_table.head().parts) == ["202401", "202404"]
    log = spark.read.parquet(f"{root}/log").first()
    assert (log.natural_key, log.dq_fail_reason) == ("4", "Invalid listen_duration")


def test_untouched_months_keep_their_folders(spark, root):
    table = SnapshotTable(spark, f"{root}/facts", silver.FACT_DDL)
    for i, key in enumerate((20240105, 20240205)):
        rows = spark.createDataFrame([play(i, key, 5)], PLAY)
        silver.apply_fact_batch(rows, i, table, f"{root}/log")
    parts = table.head().parts
    folders = {name: [path.partition("-")[0] for path in parts[name]] for name in ("202401", "202402")}
    assert folders == {"202401": ["data/v=00000001"], "202402": ["data/v=00000002"]}


def test_facts_stored_by_day(spark, root):
    table = SnapshotTable(spark, f"{root}/facts", silver.FACT_DDL)
    for i, (key, listen) in enumerate([(20240105, 5), (20240106, 6)]):
        rows = spark.createDataFrame([play(1, key, listen), play(2 + i, 20240105, 9)], PLAY)
        silver.apply_fact_batch(rows, i, table, f"{root}/log", grain="day")
    assert sorted(table.head().parts) == ["20240105", "20240106"]
    got = sorted((r.stream_id, r.date_key, r.listen_duration) for r in table.read().collect())
    assert got == [(1, 20240106, 6), (2, 20240105, 9), (3, 20240105, 9)]


def test_keep_latest_before_merge_gives_unique_keys(spark):
    df = facts(spark, [(1, 1, 1, 1, "a", n) for n in range(5)])
    assert keep_latest(df, ["stream_id"], ["at"], []).count() == 1
