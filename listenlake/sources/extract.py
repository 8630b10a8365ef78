"""Incremental extraction from source tables by high watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listenlake.sources.state import StateLog

MARK = "cdc"


@dataclass(frozen=True)
class SourceSpec:
    """A source table, the column that orders its changes, and an optional backfill start.

    A non-empty ``from_date`` replaces the stored watermark.
    """

    name: str
    cdc_col: str
    read: Callable[[SparkSession], DataFrame]
    from_date: str = ""


@dataclass(frozen=True)
class Landed:
    """``rows`` is counted while the rows are written, so it may be too high if a task was run twice.

    The mark is a maximum, which repeated tasks don't change.
    """

    name: str
    rows: int
    mark: str | None


def parquet_source(path: str) -> Callable[[SparkSession], DataFrame]:
    return lambda spark: spark.read.parquet(path)


def jdbc_source(url: str, table: str, **options: str) -> Callable[[SparkSession], DataFrame]:
    """A relational table. Spark turns the watermark filter into the WHERE clause of its query.

    For a parallel read pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``; without them one task reads everything.
    """
    return lambda spark: spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def extract_incremental(
    df: DataFrame,
    cdc_col: str,
    last: str | None,
    from_date: str | None = None,
    overlap: str | None = None,
) -> DataFrame:
    """Rows strictly after the watermark, or after ``from_date`` if that is given.

    The bound is a constant of the column's own type, so the filter reaches the source. A row
    committed later with the very time of the mark would be missed; ``overlap`` (an interval, for
    time columns) steps back that far, and keep-latest de-duplication drops what comes twice.
    """
    after = from_date or last
    if not after:
        return df
    bound = F.lit(after).cast(df.schema[cdc_col].dataType)
    if overlap and not from_date:
        bound = bound - F.expr(f"INTERVAL {overlap}")
    return df.filter(F.col(cdc_col) > bound)


def mark_log(spark: SparkSession, state_root: str, name: str) -> StateLog:
    return StateLog(spark, f"{state_root.rstrip('/')}/{name}_cdc")


def read_watermark(log: StateLog) -> str | None:
    entry = log.latest()
    return entry[MARK] if entry else None


def advance_watermark(log: StateLog, df: DataFrame, cdc_col: str) -> str | None:
    """Raise the mark to the highest value in ``df``; an empty frame leaves it alone."""
    return _raise(log, df.agg(F.max(cdc_col).cast("string")).first()[0], df, cdc_col)


def _raise(log: StateLog, highest: str | None, df: DataFrame, cdc_col: str) -> str | None:
    """The mark never sinks. Values are compared in the column's type, not as text."""
    last = read_watermark(log)
    if highest is None:
        return last
    kind = df.schema[cdc_col].dataType
    both = df.sparkSession.range(1).select(
        F.greatest(*[F.lit(v).cast(kind) for v in (highest, last)]).cast("string")
    )
    mark = both.first()[0]
    if mark != last:
        log.append({MARK: mark})
    return mark


def ingest(
    spark: SparkSession,
    spec: SourceSpec,
    landing_root: str,
    state_root: str,
    overlap: str | None = None,
) -> Landed:
    """Land one table's new rows and move its mark.

    The mark comes from the very rows written, counted while they are written, so rows that reach
    the source meanwhile are left for the next run. An empty increment lands nothing.
    """
    log = mark_log(spark, state_root, spec.name)
    last = read_watermark(log)
    rows = extract_incremental(spec.read(spark), spec.cdc_col, last, spec.from_date, overlap)
    if rows.isEmpty():
        return Landed(spec.name, 0, last)
    seen = Observation()
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.max(spec.cdc_col).cast("string").alias("highest"),
    )
    observed.write.mode("append").parquet(f"{landing_root.rstrip('/')}/{spec.name}")
    mark = _raise(log, seen.get["highest"], rows, spec.cdc_col)
    return Landed(spec.name, seen.get["rows"], mark)


def ingest_all(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    landing_root: str,
    state_root: str,
    overlap: str | None = None,
) -> list[Landed]:
    """Every table in turn. The loop runs over table names; the rows move in Spark jobs."""
    return [ingest(spark, spec, landing_root, state_root, overlap) for spec in specs]
