"""De-duplication, surrogate keys, slowly changing dimensions and change application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake import fixed
from listenlake.operators import cdc
from listenlake.operators.dedup import keep_latest
from listenlake.operators.durable import scratch_path
from listenlake.operators.keys import assign_sk
from listenlake.operators.rules import expect_all_or_drop, expect_or_drop
from listenlake.operators.scd import current_only, scd1_merge
from listenlake.plans import quality, silver
from listenlake.registry.sql import LINES, NATIONS, hash_steps
from listenlake.sources import sample
from listenlake.sources.snapshot import SnapshotTable

# the day at which the sample is cut into an earlier and a later batch
CUT = "1998-01-01"


def user_events(spark, sf_dir) -> DataFrame:
    """Orders as changes of a user's plan."""
    orders = sample.table(spark, sf_dir, "orders")
    user = sample.users(spark, sf_dir).select("user_id", "user_name", "country")
    return orders.join(user, F.col("o_custkey") == F.col("user_id")).select(
        "user_id",
        "user_name",
        "country",
        F.col("o_orderpriority").alias("subscription_type"),
        F.to_date("o_orderdate").alias("start_date"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        "o_orderkey",
        "o_orderstatus",
    )


USER_EVENTS = f"""{NATIONS},
user_events AS (
  SELECT o_custkey AS user_id, c_name AS user_name, country, o_orderpriority AS subscription_type,
         CAST(o_orderdate AS DATE) AS start_date, o_orderdate AS updated_at, o_orderkey,
         o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nations ON c_nationkey = n_nationkey)"""


def dedup_latest(spark, sf_dir) -> DataFrame:
    return keep_latest(
        user_events(spark, sf_dir), ["user_id"], ["updated_at"], ["o_orderkey"]
    ).drop("o_orderkey", "o_orderstatus")


def dedup_fact(spark, sf_dir) -> DataFrame:
    """Only order lines decide which play is the newest, so they are reduced before the join."""
    newest = keep_latest(
        sample.line_events(spark, sf_dir),
        ["stream_id"],
        ["stream_timestamp"],
        sample.FACT_TIEBREAK,
    )
    owner = sample.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
    )
    return newest.join(owner, "l_orderkey").select(*sample.FACT_COLS)


def _newest_facts(plays: DataFrame) -> DataFrame:
    return keep_latest(
        plays, ["stream_id"], ["stream_timestamp"], sample.FACT_TIEBREAK
    ).select(*sample.FACT_COLS)


def _two_batches(df: DataFrame, time_col: str) -> tuple[DataFrame, DataFrame]:
    at = F.col(time_col) < F.lit(CUT).cast("timestamp_ntz")
    return df.filter(at), df.filter(~at)


def scd1_fact(spark, sf_dir) -> DataFrame:
    """Later plays upserted into earlier ones."""
    earlier, later = _two_batches(sample.fact(spark, sf_dir), "stream_timestamp")
    return scd1_merge(
        _newest_facts(earlier), _newest_facts(later), ["stream_id"], fixed.FACT_UPDATE_COLS
    )


def _user_history(spark, sf_dir) -> SnapshotTable:
    """One batch per calendar year of orders, each merged into the published table."""
    users = SnapshotTable(spark, scratch_path(spark, "users"), silver.USER_DDL)
    quarantine = scratch_path(spark, "quarantine")
    span = sample.table(spark, sf_dir, "orders").agg(
        F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")
    ).first()
    events = user_events(spark, sf_dir)
    when = F.col("updated_at")
    for year in range(span["first"], span["last"] + 1):
        batch = events.filter(
            (when >= F.lit(f"{year}-01-01").cast("timestamp"))
            & (when < F.lit(f"{year + 1}-01-01").cast("timestamp"))
        )
        bronze = batch.withColumns(
            {
                "ingest_timestamp": F.current_timestamp(),
                "input_file_path": F.lit("orders.parquet"),
            }
        )
        silver.apply_user_batch(bronze, year, users, quarantine, tiebreak=["o_orderkey"])
    return users


_USER_COLS = [
    "user_sk",
    "user_id",
    "user_name",
    "country",
    "subscription_type",
    "scd_start_date",
    "scd_end_date",
    "is_current",
    "updated_at",
]


def scd2_user(spark, sf_dir) -> DataFrame:
    return _user_history(spark, sf_dir).read().select(*_USER_COLS)


def scd2_current(spark, sf_dir) -> DataFrame:
    return current_only(_user_history(spark, sf_dir).read()).select(*_USER_COLS)


_SCD2 = f"""{USER_EVENTS},
yearly AS (
  SELECT *, year(updated_at) AS batch FROM user_events
  QUALIFY row_number() OVER (PARTITION BY user_id, year(updated_at)
                             ORDER BY updated_at DESC, o_orderkey DESC) = 1),
compared AS (
  SELECT *, lag(subscription_type) OVER (PARTITION BY user_id ORDER BY batch) AS before
  FROM yearly),
kept AS (SELECT * FROM compared WHERE subscription_type IS DISTINCT FROM before),
scd2 AS (
  SELECT row_number() OVER (ORDER BY batch, user_id) AS user_sk, user_id, user_name, country,
         subscription_type, start_date AS scd_start_date,
         lead(start_date) OVER (PARTITION BY user_id ORDER BY batch) AS scd_end_date,
         lead(start_date) OVER (PARTITION BY user_id ORDER BY batch) IS NULL AS is_current,
         updated_at
  FROM kept)"""


def surrogate_key(spark, sf_dir) -> DataFrame:
    """Orders numbered on from an existing maximum."""
    orders = sample.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return assign_sk(orders, ["o_orderkey"], "order_sk", start=1000)


def _line_changes(spark, sf_dir) -> DataFrame:
    return sample.table(spark, sf_dir, "lineitem")


_LINE_TIES = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_linestatus",
]


def _applied(events: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Open lines first, all others after: both batches span all days, so the second is late."""
    first = events.filter(F.col("l_linestatus") == "O")
    second = events.filter(F.col("l_linestatus") != "O")
    target = cdc.apply_latest(None, first, [key], "updated_at", _LINE_TIES)
    return cdc.apply_latest(target, second, [key], "updated_at", _LINE_TIES).select(*cols)


def _applied_sql(columns: str, key: str, source: str) -> str:
    """Newest event per key; on equal times the later batch wins."""
    return f"""SELECT {columns} FROM {source}
QUALIFY row_number() OVER (PARTITION BY {key}
  ORDER BY l_shipdate DESC, l_linestatus <> 'O' DESC, l_orderkey DESC, l_linenumber DESC,
           l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_linestatus DESC) = 1"""


def cdc_scd1_artist(spark, sf_dir) -> DataFrame:
    """Each order line renames its artist's label country and moves its time on."""
    artist = sample.artists(spark, sf_dir).drop("artist_sk")
    lines = _line_changes(spark, sf_dir)
    events = lines.join(artist, F.col("l_suppkey") == F.col("artist_id")).select(
        "artist_id",
        "artist_name",
        "genre",
        F.concat_ws(" ", "country", "l_linestatus").alias("country"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.hash("artist_id").alias("artist_sk"),
        *_LINE_TIES,
    )
    events = expect_or_drop(events, *quality.ARTIST_EXPECTATION)
    cols = ["artist_id", "artist_name", "genre", "country", "updated_at", "artist_sk"]
    return _applied(events, cols, "artist_id")


def cdc_scd1_track(spark, sf_dir) -> DataFrame:
    """Each order line sets its track's length."""
    track = sample.tracks(spark, sf_dir).drop("duration_sec", "artist_id")
    lines = _line_changes(spark, sf_dir)
    events = lines.join(track, F.col("l_partkey") == F.col("track_id")).select(
        "track_id",
        "track_name",
        "album_name",
        F.col("l_quantity").cast("int").alias("duration_sec"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        "track_sk",
        *_LINE_TIES,
    )
    cols = ["track_id", "track_name", "album_name", "duration_sec", "updated_at", "track_sk"]
    return _applied(events, cols, "track_id")


def cdc_scd1_date(spark, sf_dir) -> DataFrame:
    """Days as they occur on order lines, many times each, in two batches that share most days."""
    at = F.col("l_shipdate")
    events = _line_changes(spark, sf_dir).select(
        sample.date_key("l_shipdate").alias("date_key"),
        F.to_date(at).alias("date"),
        F.dayofmonth(at).alias("day"),
        F.month(at).alias("month"),
        F.year(at).alias("year"),
        F.date_format(at, "E").alias("weekday"),
        "l_linestatus",
    )
    ties, target = ["day", "month", "year", "weekday"], None
    for is_open in (F.col("l_linestatus") == "O", F.col("l_linestatus") != "O"):
        batch = events.filter(is_open).drop("l_linestatus")
        target = cdc.apply_latest(target, batch, ["date_key"], "date", ties)
    return target


def cdc_scd1_fact(spark, sf_dir) -> DataFrame:
    """Plays applied in two batches by time of the play; rows without a stream id are dropped."""
    plays = expect_all_or_drop(sample.fact(spark, sf_dir), quality.FACT_EXPECTATIONS)
    later, earlier = _two_batches(plays, "stream_timestamp")
    ties = list(sample.FACT_TIEBREAK)
    target = cdc.apply_latest(None, earlier, ["stream_id"], "stream_timestamp", ties)
    merged = cdc.apply_latest(target, later, ["stream_id"], "stream_timestamp", ties)
    return merged.select(*sample.FACT_COLS)


def _user_cdc(hot_rows: int, except_cols):
    def run(spark, sf_dir):
        events = expect_all_or_drop(user_events(spark, sf_dir), quality.USER_EXPECTATIONS)
        # open orders first, all others after: the second batch brings late events
        first = events.filter(F.col("o_orderstatus") == "O").drop("o_orderstatus")
        second = events.filter(F.col("o_orderstatus") != "O").drop("o_orderstatus")
        state = None
        for batch in (first, second):
            state = cdc.apply_history(
                state, batch, ["user_id"], "updated_at", ["o_orderkey"], except_cols, hot_rows
            )
        return cdc.versions(state).select(
            "user_id", "user_name", "country", "subscription_type", "updated_at",
            cdc.START_AT, cdc.END_AT,
        )

    return run


_NOT_TRACKED = ("start_date", "updated_at", "o_orderkey")

_CDC2 = f"""{USER_EVENTS},
events1 AS (
  SELECT * FROM user_events
  QUALIFY row_number() OVER (PARTITION BY user_id, updated_at
                             ORDER BY o_orderstatus <> 'O' DESC, o_orderkey DESC) = 1)"""

_CDC2_COLS = """user_id, user_name, country, subscription_type, updated_at,
  updated_at AS start_at,
  lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS end_at"""

_CDC2_COLLAPSED = f"""WITH {_CDC2},
marked AS (
  SELECT *, lag(subscription_type) OVER (PARTITION BY user_id ORDER BY updated_at) AS before
  FROM events1)
SELECT {_CDC2_COLS} FROM marked WHERE subscription_type IS DISTINCT FROM before"""


QUERIES = {
    "dedup_latest": dedup_latest,
    "dedup_fact": dedup_fact,
    "scd1_fact": scd1_fact,
    "scd2_user": scd2_user,
    "scd2_current": scd2_current,
    "surrogate_key": surrogate_key,
    "cdc_scd1_artist": cdc_scd1_artist,
    "cdc_scd1_track": cdc_scd1_track,
    "cdc_scd1_date": cdc_scd1_date,
    "cdc_scd1_fact": cdc_scd1_fact,
    "cdc_scd2_user": _user_cdc(cdc.HOT_ROWS, cdc.AUDIT),
    "cdc_scd2_user_collapsed": _user_cdc(cdc.HOT_ROWS, _NOT_TRACKED),
    # no key allowed to be sorted by one task: takes the path for hot keys
    "cdc_scd2_user_segmented": _user_cdc(0, _NOT_TRACKED),
}

_FACT_COLS = ", ".join(sample.FACT_COLS)
def _newest_fact(ties: str) -> str:
    return f"""QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY stream_timestamp DESC, {ties}) = 1"""


_LINE_ORDER = "track_id DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"
_NEWEST_FACT = _newest_fact(_LINE_ORDER)


def scd1_sql(ties: str) -> str:
    """Plays of the later batch merged into those of the earlier one; ``ties`` orders plays of one time."""
    newest = _newest_fact(ties)
    return f"""
before AS (SELECT * FROM plays WHERE stream_timestamp < TIMESTAMP '{CUT}' {newest}),
after AS (SELECT * FROM plays WHERE stream_timestamp >= TIMESTAMP '{CUT}' {newest})
SELECT stream_id, coalesce(b.user_id, a.user_id) AS user_id,
       coalesce(b.track_id, a.track_id) AS track_id, coalesce(a.date_key, b.date_key) AS date_key,
       coalesce(a.listen_duration, b.listen_duration) AS listen_duration,
       coalesce(a.device_type, b.device_type) AS device_type,
       coalesce(b.stream_timestamp, a.stream_timestamp) AS stream_timestamp
FROM before b FULL JOIN after a USING (stream_id)"""


ORACLES = {
    "dedup_latest": f"""WITH {USER_EVENTS}
SELECT * EXCLUDE (o_orderkey, o_orderstatus) FROM user_events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, o_orderkey DESC) = 1""",
    "dedup_fact": f"WITH {LINES} SELECT {_FACT_COLS} FROM lines {_NEWEST_FACT}",
    "scd1_fact": f"WITH {LINES}, plays AS (SELECT * FROM lines), {scd1_sql(_LINE_ORDER)}",
    "scd2_user": f"WITH {_SCD2} SELECT * FROM scd2",
    "scd2_current": f"WITH {_SCD2} SELECT * FROM scd2 WHERE is_current",
    "surrogate_key": """SELECT o_orderkey, o_custkey,
       row_number() OVER (ORDER BY o_orderkey) + 1000 AS order_sk FROM orders""",
    "cdc_scd1_artist": f"""WITH {NATIONS}, {hash_steps('supplier', 's_suppkey')}
{_applied_sql('''l_suppkey AS artist_id, s_name AS artist_name, genre,
  country || ' ' || l_linestatus AS country, l_shipdate AS updated_at, hash AS artist_sk''',
  'l_suppkey', '''lineitem JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nations ON s_nationkey = n_nationkey JOIN h_out ON key = s_suppkey''')}""",
    "cdc_scd1_track": _applied_sql(
        """p_partkey AS track_id, p_name AS track_name, p_brand AS album_name,
  CAST(l_quantity AS INTEGER) AS duration_sec, l_shipdate AS updated_at, p_partkey AS track_sk""",
        "l_partkey",
        "lineitem JOIN part ON l_partkey = p_partkey",
    ),
    "cdc_scd1_date": """SELECT DISTINCT
       CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER)
         AS date_key,
       CAST(l_shipdate AS DATE) AS date, CAST(day(l_shipdate) AS INTEGER) AS day,
       CAST(month(l_shipdate) AS INTEGER) AS month, CAST(year(l_shipdate) AS INTEGER) AS year,
       strftime(l_shipdate, '%a') AS weekday FROM lineitem""",
    "cdc_scd1_fact": f"WITH {LINES} SELECT {_FACT_COLS} FROM lines {_NEWEST_FACT}",
    "cdc_scd2_user": f"WITH {_CDC2} SELECT {_CDC2_COLS} FROM events1",
    "cdc_scd2_user_collapsed": _CDC2_COLLAPSED,
    "cdc_scd2_user_segmented": _CDC2_COLLAPSED,
}
