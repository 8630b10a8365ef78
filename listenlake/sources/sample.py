"""The star tables, derived from a folder of order-processing parquet tables.

A line of an order stands for one play: the customer is the user, the part the track, and the
supplier the artist.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.operators.keys import hash_sk
from listenlake.plans.star import Star

# settles plays of one stream at the same time, on top of the ship date
FACT_TIEBREAK = ("track_id", "l_suppkey", "l_quantity", "l_extendedprice")


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The footer of a table is looked up once per session; its files do not change."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def date_key(ts: str) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays before the user is known; several lines may share a stream id."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("stream_id"),
        "l_orderkey",
        F.col("l_partkey").alias("track_id"),
        date_key("l_shipdate").alias("date_key"),
        (F.col("l_quantity").cast("int") - 1).alias("listen_duration"),
        F.col("l_returnflag").alias("device_type"),
        F.col("l_shipdate").alias("stream_timestamp"),
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw plays: duplicates and zero-length plays included."""
    owner = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
    )
    return line_events(spark, sf_dir).join(owner, "l_orderkey").drop("l_orderkey")


FACT_COLS = (
    "stream_id",
    "user_id",
    "track_id",
    "date_key",
    "listen_duration",
    "device_type",
    "stream_timestamp",
)


# fact columns that only tell which play of a stream is the newest
NOT_WIDE = ("stream_timestamp", "l_suppkey", "l_quantity", "l_extendedprice")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("genre")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keys are dense from zero, so the next integer is their surrogate number."""
    customer = table(spark, sf_dir, "customer")
    nation = nations(spark, sf_dir)
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        (F.col("c_custkey") + 1).alias("user_sk"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        "country",
        F.col("c_mktsegment").alias("subscription_type"),
    )


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = nations(spark, sf_dir)
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("artist_id"),
        hash_sk("s_suppkey").alias("artist_sk"),
        F.col("s_name").alias("artist_name"),
        "genre",
        "country",
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are dealt out to all suppliers in turn."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_partkey").alias("track_sk"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("album_name"),
        (F.col("p_partkey") % suppliers).alias("artist_id"),
        F.col("p_size").alias("duration_sec"),
    )


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.date_format("date", "EEEE").alias("weekday"),
    )


def star(spark: SparkSession, sf_dir: str, kept: Callable[[DataFrame], DataFrame] = lambda plays: plays) -> Star:
    """``kept`` may store the fact, for stars that are read many times."""
    dims = (partial(build, spark, sf_dir) for build in (users, tracks, artists, dates))
    return Star(lambda: kept(fact(spark, sf_dir)), *dims)
