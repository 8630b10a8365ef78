"""Ranks that do not gather a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 2**12 neighbouring integer scores form one band
BAND_BITS = 12
# least number of shuffle keys over which the rows of one score are spread when they fetch their rank
LEAST_SPREAD = 16


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(
        lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in pairs)
    )


def _sum_above(value: str, by: Sequence[str], order: str) -> Column:
    """Total of the rows that sort strictly higher inside the group."""
    window = (
        Window.partitionBy(*by)
        .orderBy(F.col(order).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def rank_in_group(df: DataFrame, by: Sequence[str], score: str, name: str) -> DataFrame:
    """``rank() over (partition by by order by score desc)`` for an integer score.

    A rank is one plus the number of rows with a higher score. The rows are first counted per
    score (combined on the map side), and the counts are summed in two levels: inside bands of
    4,096 neighbouring scores, and over bands. So no window ever holds more than one band or one
    row per band, and the group itself, which may be a third of all users, is never sorted.
    The ranks, few beside the rows, are repeated so that rows of one common score can fetch
    theirs in several tasks, a tenth of all partitions: a score of which one task could not hold
    the rows would have more than those.
    """
    spread_over = max(LEAST_SPREAD, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 10)
    counts = (
        df.groupBy(*by, score)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_band", F.shiftright(F.col(score).cast("bigint"), BAND_BITS))
    )
    bands = counts.groupBy(*by, "_band").agg(F.sum("_rows").alias("_rows"))
    bands = bands.select(
        *[F.col(c).alias(f"_b_{c}") for c in by],
        F.col("_band").alias("_b_band"),
        _sum_above("_rows", by, "_band").alias("_in_higher_bands"),
    )
    inside = counts.withColumn("_in_band_above", _sum_above("_rows", [*by, "_band"], score))
    ranks = inside.join(
        bands, null_safe(inside, bands, [*((c, f"_b_{c}") for c in by), ("_band", "_b_band")])
    ).select(
        *[F.col(c).alias(f"_r_{c}") for c in [*by, score]],
        (F.col("_in_higher_bands") + F.col("_in_band_above") + 1).cast("int").alias(name),
    )
    ranks = ranks.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(spread_over - 1))))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread_over)).cast("int")
    spread = df.withColumn("_salt", salt)
    on = null_safe(spread, ranks, [(c, f"_r_{c}") for c in [*by, score]])
    on &= spread["_salt"] == ranks["_copy"]
    return spread.join(ranks, on).select(*[spread[c] for c in df.columns], ranks[name])


def top_with_ties(df: DataFrame, n: int, order: str, name: str) -> DataFrame:
    """Rows with ``rank() over (order by order desc) <= n``, ties included.

    The ``n`` highest values alone decide who is in: they come from a distributed top-n, are
    ranked (at most ``n`` rows), and are joined back as a broadcast of at most ``n`` rows. A tie
    of any size stays spread over its partitions. Reads ``df`` twice, so give it a stored table.
    """
    best = df.orderBy(F.col(order).desc()).limit(n).select(F.col(order).alias("_value"))
    ranked = best.select(
        "_value", F.rank().over(Window.orderBy(F.col("_value").desc())).alias(name)
    ).distinct()
    return df.join(F.broadcast(ranked), df[order].eqNullSafe(F.col("_value"))).drop("_value")
