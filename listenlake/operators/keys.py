"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlake.operators.durable import materialise

# monotonically_increasing_id(): partition number above these bits, row position below
POSITION_BITS = 33


def hash_sk(*cols: str) -> Column:
    """32-bit hash of the natural key. Distinct keys may collide, as with any 32-bit hash."""
    return F.hash(*cols)


def assign_sk(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Dense numbers ``start + 1, start + 2, …`` in the order of ``order``.

    ``order`` should be unique. A ``row_number`` over the whole frame would sort it in one task;
    here the sort is a range-partitioned one, each row notes its position in its partition, and
    the partition sizes (one row per partition, hence the safe broadcast) turn positions into
    numbers. The positions are written out before the sizes are taken, so both come from the same
    layout even if tasks are retried.
    """
    placed = materialise(
        df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "numbered"
    ).withColumn("_part", F.shiftright("_slot", POSITION_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(start + 1))
        .drop("_part", "_slot", "_offset")
    )
