"""Slowly changing dimensions as DataFrame merges.

Sources hold one row per key (see ``keep_latest``), as do type 1 targets and the current rows of
type 2 targets. Joins are one to one, so no key is hot. ``small`` says that the source has been
measured to fit a broadcast (see ``fits_broadcast``): the target is then never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.operators.keys import assign_sk

START, END, CURRENT = "scd_start_date", "scd_end_date", "is_current"


def not_older(source_seq: Column, target_seq: Column, ties: Sequence[tuple[Column, Column]] = ()) -> Column:
    """A source event may overwrite: it is as new as the target, or the target has no time.

    Of two events of one time the one with the higher ``ties`` is the newer, as in ``keep_latest``;
    without ties the source is.
    """
    newer = F.coalesce(source_seq >= target_seq, F.lit(False))
    if ties:
        ours, theirs = (F.struct(*side) for side in zip(*ties))
        newer &= F.coalesce(source_seq > target_seq, F.lit(False)) | (ours >= theirs)
    return target_seq.isNull() | newer


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Like a join on column names, but missing keys are equal: rows without a key are one key's rows."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    joined = left.join(named, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_right_{k}") for k in keys})
    return joined.drop(*[f"_right_{k}" for k in keys])


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    guard: str | None = None,
    small: bool = False,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Upsert: matched rows take ``update_cols`` from the source, unmatched source rows are added.

    Without ``guard`` a later batch always overwrites. With it, only events whose ``guard``
    column is not older than the target's do, ``ties`` settling equal ones. Missing keys are equal to
    each other. Each side is read once, but for a small source,
    which is read three times to read the target in place.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    changes = source.select(
        *keys, *[F.col(c).alias(f"_s_{c}") for c in rest], F.lit(True).alias("_hit")
    )
    old = target.withColumn("_old", F.lit(True))
    merged = join_on_keys(old, _maybe_broadcast(changes, small), keys, "left" if small else "full")
    overwrites = F.col("_hit").isNotNull()
    if guard:
        pairs = [(F.col(f"_s_{c}"), F.col(c)) for c in ties]
        overwrites &= not_older(F.col(f"_s_{guard}"), F.col(guard), pairs)
    is_new = F.col("_old").isNull()
    values = {
        c: F.when(is_new | overwrites if c in update_cols else is_new, F.col(f"_s_{c}"))
        .otherwise(F.col(c))
        .alias(c)
        for c in rest
    }
    merged = merged.select(*[values.get(c, c) for c in target.columns])
    if not small:
        return merged
    wanted = F.broadcast(source.select(*keys))
    known = join_on_keys(target, wanted, keys, "left_semi").select(*keys)
    added = join_on_keys(source, known, keys, "left_anti").select(*target.columns)
    return merged.unionByName(added)


@dataclass(frozen=True)
class Scd2Change:
    """Outcome of a type 2 merge.

    ``rows`` holds what was current before, closed where it changed, and what was added;
    ``added`` the latter alone. Closed rows belong to history, which only grows.
    """

    rows: DataFrame
    added: DataFrame


def scd2_merge(
    current: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    start: str,
    sk: str,
    sk_start: int = 0,
    guard: str | None = None,
    gap_free: bool = True,
    small: bool = False,
) -> Scd2Change:
    """Close current rows whose tracked columns changed; add new versions and new keys.

    Intervals are half open: a closed row ends at the start of its successor. The change test is
    null safe. Surrogate numbers are dealt in key order to the rows that are added; without
    ``gap_free`` they are dealt to all source rows, and those of unchanged rows are lost.
    ``source`` is read twice; pass a persisted or stored frame.
    """
    keys = list(keys)
    compared = dict.fromkeys([*tracked, *([guard] if guard else [])])
    seen = current.select(*keys, *[F.col(c).alias(f"_c_{c}") for c in compared])
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in tracked))
    if guard:
        differs &= not_older(F.col(guard), F.col(f"_c_{guard}"))
    # an inner join, as an outer one could not broadcast the source to the target
    hits = join_on_keys(seen, _maybe_broadcast(source, small), keys, "inner").select(
        *keys, differs.alias("_changed")
    )
    judged = join_on_keys(source, hits, keys, "left")
    is_added = F.coalesce("_changed", F.lit(True))
    if gap_free:
        added = assign_sk(judged.filter(is_added), keys, sk, sk_start)
    else:
        added = assign_sk(judged, keys, sk, sk_start).filter(is_added)
    closing = added.filter(F.col("_changed")).select(*keys, F.col(start).alias("_closed_on"))
    added = (
        added.withColumnRenamed(start, START)
        .withColumns({END: F.lit(None).cast("date"), CURRENT: F.lit(True)})
        .select(*current.columns)
    )
    closing = closing.withColumn("_closes", F.lit(True))
    closes = F.col("_closes").isNotNull()
    before = (
        join_on_keys(current, _maybe_broadcast(closing, small), keys, "left")
        .withColumns({END: F.when(closes, F.col("_closed_on")), CURRENT: ~closes})
        .select(*current.columns)
    )
    return Scd2Change(before.unionByName(added), added)


def current_only(df: DataFrame) -> DataFrame:
    """The current version of every key of a type 2 table."""
    return df.filter(F.col(CURRENT))
