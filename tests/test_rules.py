import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from listenlake.operators.quarantine import to_quarantine, write_quarantine
from listenlake.operators.rules import (
    apply_rules,
    expect_all_or_drop,
    expect_or_drop,
    rule_counts,
    split_valid,
)
from listenlake.plans import quality

USER = "user_id long, user_name string, country string, subscription_type string"

USERS = [
    (None, "alice", "NO", "Free"),
    (2, None, "NO", "Free"),
    (3, "al", "NO", "Free"),
    (4, "alice", None, "Free"),
    (5, "alice", "NO", None),
    (6, "alice", "NO", "Student"),
    (7, "al", None, "Free"),
    (8, "alice", "NO", "Family"),
]


def test_user_rules_name_the_first_failure_and_let_soft_ones_pass(spark):
    checked = apply_rules(spark.createDataFrame(USERS, USER), quality.user_rules())
    got = [(r.dq_is_valid, r.dq_fail_reason) for r in checked.collect()]
    assert got == [
        (False, "Missing user_id"),
        (False, "Missing user_name"),
        (True, "Invalid user_name"),
        (False, "Missing country"),
        (False, "Missing subscription_type"),
        (True, "Invalid subscription_type"),
        (False, "Invalid user_name"),  # a soft reason may hide a later hard one
        (True, None),
    ]
    counts = rule_counts(checked).first()
    assert (counts.valid_rows, counts.invalid_rows, counts.soft_failures) == (3, 5, 2)
    valid, invalid = split_valid(checked)
    assert valid.count() + invalid.count() == len(USERS)


def test_fact_rules_never_give_an_unknown_flag(spark):
    good = spark.sql(
        "SELECT 1L AS stream_id, 1L AS user_id, 1L AS track_id, "
        "timestamp_ntz'2024-01-01' AS stream_timestamp, 'web' AS device_type, 30 AS listen_duration"
    )
    names = good.columns
    frames = [good]
    for c in names:
        frames.append(good.withColumn(c, F.lit(None).cast(good.schema[c].dataType)))
    frames.append(good.withColumn("listen_duration", F.lit(0)))
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    got = [(r.dq_is_valid, r.dq_fail_reason) for r in apply_rules(df, quality.FACT_RULES).collect()]
    assert got == [
        (True, None),
        (False, "Missing stream_id"),
        (False, "Missing user_id"),
        (False, "Missing track_id"),
        (False, "Missing stream_timestamp"),
        (False, "Missing device_type"),
        (False, "Missing listen_duration"),
        (False, "Invalid listen_duration"),
    ]


def test_expectations_keep_only_what_is_true_and_count_failures(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "ab"), (3, None)], "artist_id long, artist_name string")
    seen = Observation()
    kept = expect_or_drop(df, *quality.ARTIST_EXPECTATION, observation=seen)
    assert [r.artist_id for r in kept.collect()] == [1]
    assert seen.get == {"valid_artist_name": 2}
    users = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "user_id long, user_name string")
    assert expect_all_or_drop(users, quality.USER_EXPECTATIONS).count() == 1


def test_quarantine_holds_the_row_and_replays_do_not_double(spark, root):
    df = spark.createDataFrame(
        [(*u, "file:/a.parquet") for u in USERS], USER + ", input_file_path string"
    )
    invalid = split_valid(apply_rules(df, quality.user_rules()))[1]
    log = to_quarantine(invalid, "DimUser", "user_id")
    for batch in (0, 1, 1):
        write_quarantine(log, f"{root}/log", batch)
    stored = spark.read.parquet(f"{root}/log")
    assert stored.count() == 2 * 5
    row = stored.filter("batch_id = 1 AND natural_key = '4'").first()
    assert json.loads(row.raw_record) == {
        "user_id": 4,
        "user_name": "alice",
        "subscription_type": "Free",
        "input_file_path": "file:/a.parquet",
    }
    assert row.source_table == "DimUser" and row.input_file_path == "file:/a.parquet"
