"""One run over all layers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from listenlake import fixed
from listenlake.operators.durable import clear_scratch
from listenlake.plans import catalog, gold
from listenlake.plans.rollup import KpiState
from listenlake.sources.extract import Landed, SourceSpec, ingest_all
from listenlake.streaming.bronze import run_bronze
from listenlake.streaming.layout import Layout
from listenlake.streaming.silver import SilverLayer


def run(
    spark: SparkSession,
    layout: Layout,
    specs: Iterable[SourceSpec],
    plans: Sequence[str] = fixed.PLANS,
    max_files: int = fixed.MAX_FILES,
    fact_grain: str = "month",
    keep: int = 2,
) -> list[Landed]:
    """Extract what is new, take it through bronze and silver, refresh gold, offer it to SQL.

    ``keep`` versions of every silver table stay on disk. Meant to have the application for itself: it deletes the application's scratch files at the end.
    """
    specs = list(specs)
    landed = ingest_all(spark, specs, f"{layout.root}/landing", layout.marks())
    run_bronze(spark, layout, [spec.name for spec in specs], max_files)
    layer = SilverLayer(spark, layout, plans, max_files, fact_grain)
    layer.run()
    _offer(spark, layout, layer, keep)
    # every result is in a table by now
    clear_scratch(spark)
    return landed


def _offer(spark: SparkSession, layout: Layout, layer: SilverLayer, keep: int) -> None:
    """Silver and gold by name, gold brought up to silver."""
    star = catalog.register_silver(
        spark, layer.users, layer.facts, layer.artists, layer.tracks, layer.dates
    )
    gold.refresh(star, layout.gold, KpiState(spark, layer.facts, star, layout.kpi_state()))
    catalog.register_gold(spark, layout.gold)
    layer.vacuum(keep)


def rebuild(
    spark: SparkSession,
    layout: Layout,
    plans: Sequence[str] = fixed.PLANS,
    max_files: int = fixed.MAX_FILES,
    fact_grain: str = "month",
    keep: int = 2,
) -> Layout:
    """Make silver and gold anew from all of bronze, as after a change of rules or grain.

    The new tables come with new checkpoints under the next name of ``run``, so no batch is taken for done and the old tables
    can be read until gold is there. Returns the layout to go on with; ``fs.delete`` on the old one's silver folder and
    checkpoints frees their space. A rebuild that breaks off goes on where it was if it is called with the same layout.
    """
    fresh = layout.next_run()
    layer = SilverLayer(spark, fresh, plans, max_files, fact_grain)
    layer.run()
    _offer(spark, fresh, layer, keep)
    clear_scratch(spark)
    return fresh
