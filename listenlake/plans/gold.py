"""Refresh of the KPI tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.plans.kpi import KPIS, stamp
from listenlake.plans.rollup import KpiState
from listenlake.plans.star import Star
from listenlake.sources.snapshot import PART, SnapshotTable

PARTITIONED_BY = {"monthly_trend_kpi": "year"}


def write_gold(df: DataFrame, path: str, part_by: str | None = None, keep: int = 2) -> None:
    """Publish a new version: readers see the old table until all of the new one is there.

    ``keep`` versions stay on disk for readers that have opened one.
    """
    table = SnapshotTable(df.sparkSession, path, df.schema)
    head = table.head()
    part = F.coalesce(F.col(part_by).cast("string"), F.lit("none")) if part_by else F.lit("all")
    table.publish(df.withColumn(PART, part), head.batch_id + 1, head=head)
    table.vacuum(keep)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a KPI table."""
    return SnapshotTable(spark, path).read()


def refresh(star: Star, path_of: Callable[[str], str], state: KpiState | None = None) -> None:
    """Rewrite every KPI table. ``path_of`` maps a table name to its folder.

    Each table reads the few fact columns it needs; a stored wide view would be larger than the
    fact itself. The star measures its dimensions and hot keys once, for all tables. With ``state``, only the parts
    of the fact are read that were written since the last refresh.
    """
    if state:
        state.refresh()
    for name, build in KPIS.items():
        write_gold(stamp(state.kpi(name) if state else build(star)), path_of(name), PARTITIONED_BY.get(name))
