"""Sequenced change application: events may arrive late and out of order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlake.functions.audit import BRONZE_AUDIT, SILVER_AUDIT
from listenlake.operators.dedup import keep_latest
from listenlake.operators.durable import materialise
from listenlake.operators.scd import join_on_keys, scd1_merge

START_AT, END_AT, OPENS = "start_at", "end_at", "opens_version"
AUDIT = tuple(dict.fromkeys([*BRONZE_AUDIT, *SILVER_AUDIT]))
# a key with more events than this is no longer sorted by one task
HOT_ROWS = 1_000_000


def apply_latest(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tiebreak: Sequence[str],
    small: bool = False,
) -> DataFrame:
    """Type 1: one row per key, from the event with the highest sequence.

    On equal sequences the source beats the target, and ``tiebreak`` decides inside the source.
    ``small`` as in ``scd1_merge``.
    """
    newest = keep_latest(source, keys, [sequence_by], tiebreak)
    if target is None:
        return newest
    rest = [c for c in target.columns if c not in keys]
    return scd1_merge(target, newest, keys, rest, guard=sequence_by, small=small)


def apply_history(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tiebreak: Sequence[str],
    except_cols: Sequence[str] = AUDIT,
    hot_rows: int = HOT_ROWS,
    settled: bool = False,
) -> DataFrame:
    """Type 2: every event, with the validity interval of the version it opens.

    An event opens a version when it is the first of its key or differs from the one before in
    any column outside ``except_cols``. Events that open none are kept beside the versions (with
    no interval), because a late event may still come to lie before them; so the result is the
    same however the events are cut into batches. ``versions`` gives the versions alone.

    Of two events of one key and time the source beats the target. With ``settled``, ``tiebreak``
    decides between them too, so that the cut into batches doesn't matter for ties either.

    Missing keys are one key. Only keys named by the source are rebuilt.
    """
    keys = list(keys)
    events = keep_latest(source, [*keys, sequence_by], [], tiebreak)
    untouched = None
    if target is not None:
        touched = source.select(*keys).distinct()
        known = join_on_keys(target, touched, keys, "left_semi").select(*source.columns)
        untouched = join_on_keys(target, touched, keys, "left_anti")
        events = keep_latest(
            events.withColumn("_is_new", F.lit(1)).unionByName(
                known.withColumn("_is_new", F.lit(0))
            ),
            [*keys, sequence_by],
            [] if settled else ["_is_new"],
            tiebreak if settled else [],
        ).drop("_is_new")
    events = materialise(events, "cdc-events")
    tracked = [c for c in source.columns if c not in keys and c not in except_cols]
    per_key = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = materialise(per_key.filter(F.col("_rows") > hot_rows).select(*keys), "hot-keys")
    if hot.isEmpty():
        rebuilt = _by_key(events, keys, sequence_by, tracked)
    else:  # only the keys with many events take the longer way
        large = join_on_keys(events, hot, keys, "left_semi")
        rest = join_on_keys(events, hot, keys, "left_anti")
        rebuilt = _by_key(rest, keys, sequence_by, tracked).unionByName(
            _by_segment(large, keys, sequence_by, tracked), allowMissingColumns=True
        )
    rebuilt = rebuilt.select(*source.columns, START_AT, END_AT, OPENS)
    return rebuilt if untouched is None else untouched.unionByName(rebuilt)


def versions(history: DataFrame) -> DataFrame:
    return history.filter(OPENS).drop(OPENS)


def _interval(df: DataFrame, sequence_by: str, next_open: Column) -> DataFrame:
    return df.withColumns(
        {
            START_AT: F.when(F.col(OPENS), F.col(sequence_by)),
            END_AT: F.when(F.col(OPENS), next_open),
        }
    )


def _by_key(
    events: DataFrame, keys: list[str], sequence_by: str, tracked: list[str]
) -> DataFrame:
    """Each key sorted by one task: for keys known to have few events.

    Looking ahead is written as looking back in the opposite order, which runs in linear time.
    """
    forward = Window.partitionBy(*keys).orderBy(sequence_by)
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col(sequence_by).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    state = F.struct(*tracked)
    marked = events.withColumn(OPENS, ~state.eqNullSafe(F.lag(state).over(forward)))
    next_open = F.last(F.when(F.col(OPENS), F.col(sequence_by)), ignorenulls=True).over(later)
    return _interval(marked, sequence_by, next_open)


def _by_segment(
    events: DataFrame, keys: list[str], sequence_by: str, tracked: list[str]
) -> DataFrame:
    """Keys of any size: the events are range-partitioned by key and sequence into segments.

    A key may run over many segments. Windows look inside one segment, and what crosses a border
    (the last event before it, the next opening after it) is one row per segment, which is small
    enough to order in one task and to broadcast. The segment number is written out first, so all
    later steps see the same segments even if tasks are retried.
    """
    place = [*keys, sequence_by]
    placed = materialise(
        events.orderBy(*place).withColumn("_segment", F.spark_partition_id()), "segments"
    ).withColumns({"_key": F.struct(*keys), "_at": F.struct(*place), "_state": F.struct(*tracked)})
    row = F.struct("_key", "_state")

    segments = Window.orderBy("_segment")
    last = placed.groupBy("_segment").agg(F.max_by(row, "_at").alias("_last"))
    before = last.select("_segment", F.lag("_last").over(segments).alias("_carried"))
    forward = Window.partitionBy("_segment").orderBy("_at")
    marked = (
        placed.join(F.broadcast(before), "_segment")
        .withColumn("_prev", F.coalesce(F.lag(row).over(forward), F.col("_carried")))
        .withColumn(OPENS, ~row.eqNullSafe(F.col("_prev")))
        .drop("_carried", "_prev")
    )

    opening = F.when(F.col(OPENS), F.col("_at"))
    first = marked.groupBy("_segment").agg(F.min(opening).alias("_first"))
    upwards = Window.orderBy(F.col("_segment").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = first.select(
        "_segment", F.last("_first", ignorenulls=True).over(upwards).alias("_carried")
    )
    later = (
        Window.partitionBy("_segment")
        .orderBy(F.col("_at").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = marked.join(F.broadcast(after), "_segment").withColumn(
        "_next", F.coalesce(F.last(opening, ignorenulls=True).over(later), F.col("_carried"))
    )
    same_key = reduce(lambda a, b: a & b, (F.col(f"_next.{k}").eqNullSafe(F.col(k)) for k in keys))
    same_key &= F.col("_next").isNotNull()
    return _interval(ahead, sequence_by, F.when(same_key, F.col(f"_next.{sequence_by}")))
