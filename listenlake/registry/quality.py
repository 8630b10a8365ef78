"""Quality queries: rules, splits, expectations, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.operators.keys import hash_sk
from listenlake.operators.quarantine import to_quarantine
from listenlake.operators.rules import (
    apply_rules,
    expect_all_or_drop,
    expect_or_drop,
    rule_counts,
    split_valid,
)
from listenlake.plans import quality
from listenlake.registry.sql import NATIONS, hash_steps
from listenlake.sources import sample

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")


def _user_input(spark, sf_dir) -> DataFrame:
    """All customers, with some values blanked or shortened so that every rule fires."""
    return sample.users(spark, sf_dir).select(
        F.expr("nullif(user_id, 5)").alias("user_id"),
        F.expr(
            "CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 7 = 0 THEN 'xy' "
            "ELSE user_name END"
        ).alias("user_name"),
        F.expr("CASE WHEN user_id % 11 = 0 THEN NULL ELSE country END").alias("country"),
        F.expr("CASE WHEN user_id % 17 = 0 THEN NULL ELSE subscription_type END").alias(
            "subscription_type"
        ),
    )


_USER_SQL = f"""{NATIONS},
raw AS (
  SELECT nullif(c_custkey, 5) AS user_id,
         CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'xy'
              ELSE c_name END AS user_name,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE country END AS country,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS subscription_type
  FROM customer LEFT JOIN nations ON c_nationkey = n_nationkey)"""

_USER_DQ = f"""WITH {_USER_SQL}
SELECT *, user_id IS NOT NULL AND user_name IS NOT NULL AND country IS NOT NULL
          AND subscription_type IS NOT NULL AS dq_is_valid,
       CASE WHEN user_id IS NULL THEN 'Missing user_id'
            WHEN user_name IS NULL THEN 'Missing user_name'
            WHEN length(user_name) <= 2 THEN 'Invalid user_name'
            WHEN country IS NULL THEN 'Missing country'
            WHEN subscription_type IS NULL THEN 'Missing subscription_type'
            WHEN subscription_type NOT IN {SEGMENTS} THEN 'Invalid subscription_type'
       END AS dq_fail_reason
FROM raw"""


def _fact_input(spark, sf_dir) -> DataFrame:
    """All events as plays, with some values blanked so that every rule fires."""
    return sample.table(spark, sf_dir, "events").selectExpr(
        "nullif(event_id, 42) AS stream_id",
        "CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id",
        "CASE WHEN event_id % 103 = 0 THEN NULL ELSE user_id % 50 END AS track_id",
        "CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS date_key",
        "CASE WHEN event_id % 107 = 0 THEN NULL ELSE CAST(floor(value) AS INT) END "
        "AS listen_duration",
        "nullif(event_type, 'error') AS device_type",
        "CASE WHEN event_id % 109 = 0 THEN NULL ELSE ts END AS stream_timestamp",
        "_metadata.file_path AS input_file_path",
    )


_FACT_SQL = """raw AS (
  SELECT nullif(event_id, 42) AS stream_id,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN event_id % 103 = 0 THEN NULL ELSE user_id % 50 END AS track_id,
         CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_key,
         CASE WHEN event_id % 107 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) END
           AS listen_duration,
         nullif(event_type, 'error') AS device_type,
         CASE WHEN event_id % 109 = 0 THEN NULL ELSE ts END AS stream_timestamp
  FROM events),
checked AS (
  SELECT *, stream_id IS NOT NULL AND user_id IS NOT NULL AND track_id IS NOT NULL
            AND stream_timestamp IS NOT NULL AND device_type IS NOT NULL
            AND coalesce(listen_duration, 0) > 0 AS dq_is_valid,
         CASE WHEN stream_id IS NULL THEN 'Missing stream_id'
              WHEN user_id IS NULL THEN 'Missing user_id'
              WHEN track_id IS NULL THEN 'Missing track_id'
              WHEN stream_timestamp IS NULL THEN 'Missing stream_timestamp'
              WHEN device_type IS NULL THEN 'Missing device_type'
              WHEN listen_duration IS NULL THEN 'Missing listen_duration'
              WHEN listen_duration <= 0 THEN 'Invalid listen_duration' END AS dq_fail_reason
  FROM raw)"""


def _artist_input(spark, sf_dir) -> DataFrame:
    """All suppliers, with some values blanked or shortened so that every rule fires."""
    return sample.artists(spark, sf_dir).selectExpr(
        "nullif(artist_id, 3) AS artist_id",
        "CASE WHEN artist_id % 7 = 0 THEN NULL WHEN artist_id % 5 = 0 THEN 'ab' "
        "ELSE artist_name END AS artist_name",
        "nullif(genre, 'ASIA') AS genre",
        "CASE WHEN artist_id % 4 = 1 THEN NULL ELSE country END AS country",
    )


_ARTIST_SQL = f"""{NATIONS},
raw AS (
  SELECT nullif(s_suppkey, 3) AS artist_id,
         CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'ab'
              ELSE s_name END AS artist_name,
         nullif(genre, 'ASIA') AS genre,
         CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE country END AS country
  FROM supplier LEFT JOIN nations ON s_nationkey = n_nationkey)"""

_ARTIST_REASON = """CASE WHEN artist_id IS NULL THEN 'artist_id is null'
            WHEN artist_name IS NULL THEN 'artist_name is null'
            WHEN genre IS NULL THEN 'genre is null'
            WHEN country IS NULL THEN 'country is null' END"""


def dq_user(spark, sf_dir) -> DataFrame:
    return apply_rules(_user_input(spark, sf_dir), quality.user_rules(SEGMENTS))


def dq_fact(spark, sf_dir) -> DataFrame:
    plays = _fact_input(spark, sf_dir).drop("input_file_path")
    return apply_rules(plays, quality.FACT_RULES)


def dq_artist(spark, sf_dir) -> DataFrame:
    return apply_rules(_artist_input(spark, sf_dir), quality.ARTIST_RULES)


def dq_split_counts(spark, sf_dir) -> DataFrame:
    return rule_counts(dq_user(spark, sf_dir))


def expect_artist(spark, sf_dir) -> DataFrame:
    return expect_or_drop(_artist_input(spark, sf_dir), *quality.ARTIST_EXPECTATION)


def expect_all_user(spark, sf_dir) -> DataFrame:
    return expect_all_or_drop(_user_input(spark, sf_dir), quality.USER_EXPECTATIONS)


def quarantine_fact(spark, sf_dir) -> DataFrame:
    """Fields are read back out of the logged JSON, which omits nulls."""
    checked = apply_rules(_fact_input(spark, sf_dir), quality.FACT_RULES)
    log = to_quarantine(split_valid(checked)[1], "FactStream", "stream_id")
    return log.select(
        "source_table",
        "natural_key",
        "dq_fail_reason",
        F.get_json_object("raw_record", "$.user_id").cast("long").alias("user_id"),
        F.get_json_object("raw_record", "$.listen_duration").cast("int").alias("listen_duration"),
        F.get_json_object("raw_record", "$.device_type").alias("device_type"),
        F.element_at(F.split("input_file_path", "/"), -1).alias("file_name"),
    )


def hash_key(spark, sf_dir) -> DataFrame:
    return sample.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("artist_id"), hash_sk("s_suppkey").alias("artist_sk")
    )


def point_lookup(spark, sf_dir) -> DataFrame:
    """Every order of one customer: the equality reaches the file scan."""
    return sample.table(spark, sf_dir, "orders").filter(F.col("o_custkey") == 20)


QUERIES = {
    "dq_user": dq_user,
    "dq_fact": dq_fact,
    "dq_artist": dq_artist,
    "dq_split_counts": dq_split_counts,
    "expect_artist": expect_artist,
    "expect_all_user": expect_all_user,
    "quarantine_fact": quarantine_fact,
    "hash_key": hash_key,
    "point_lookup": point_lookup,
}

ORACLES = {
    "dq_user": _USER_DQ,
    "dq_fact": f"WITH {_FACT_SQL} SELECT * FROM checked",
    "dq_artist": f"""WITH {_ARTIST_SQL}
SELECT *, {_ARTIST_REASON} AS dq_fail_reason, {_ARTIST_REASON} IS NULL AS dq_is_valid FROM raw""",
    "dq_split_counts": f"""SELECT count(*) FILTER (dq_is_valid) AS valid_rows,
       count(*) FILTER (NOT dq_is_valid) AS invalid_rows,
       count(*) FILTER (dq_is_valid AND dq_fail_reason IS NOT NULL) AS soft_failures
FROM ({_USER_DQ})""",
    "expect_artist": f"WITH {_ARTIST_SQL} SELECT * FROM raw WHERE length(artist_name) >= 3",
    "expect_all_user": f"""WITH {_USER_SQL}
SELECT * FROM raw WHERE user_id IS NOT NULL AND user_name IS NOT NULL""",
    "quarantine_fact": f"""WITH {_FACT_SQL}
SELECT 'FactStream' AS source_table, CAST(stream_id AS VARCHAR) AS natural_key, dq_fail_reason,
       user_id, listen_duration, device_type, 'events.parquet' AS file_name
FROM checked WHERE NOT dq_is_valid""",
    "hash_key": f"""WITH {hash_steps('supplier', 's_suppkey')}
SELECT key AS artist_id, hash AS artist_sk FROM h_out""",
    "point_lookup": "SELECT * FROM orders WHERE o_custkey = 20",
}
