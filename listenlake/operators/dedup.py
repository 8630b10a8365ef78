"""Keep-latest de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str],
) -> DataFrame:
    """One row per key: the one that sorts highest by ``order``, then by ``tiebreak``.

    The filter sits directly on ``row_number``, so Spark puts a group limit below the shuffle:
    every map task sends at most one row per key, however many rows a hot key has.
    ``tiebreak`` is mandatory, as ties would otherwise be settled by chance.
    """
    ranked = Window.partitionBy(*keys).orderBy(*newest_first([*order, *tiebreak]))
    return (
        df.withColumn("_newest", F.row_number().over(ranked))
        .filter(F.col("_newest") == 1)
        .drop("_newest")
    )
