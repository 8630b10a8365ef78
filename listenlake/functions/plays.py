"""How one play is classified, and how users and tracks are bucketed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from listenlake import fixed


def _reaches(listen: Column, duration: Column, share: tuple[int, int]) -> Column:
    """``listen >= share * duration`` in whole numbers: exact, and cheaper than decimals."""
    part, whole = (F.lit(n).cast("bigint") for n in share)
    return listen * whole >= duration * part


def is_abandoned(listen: Column) -> Column:
    """Nothing was heard. Needs no track, so it spares the track join."""
    return F.coalesce(listen, F.lit(0)) == 0


def is_skipped(listen: Column, duration: Column) -> Column:
    below = ~_reaches(listen, duration, fixed.MEANINGFUL_SHARE)
    return ~is_abandoned(listen) & F.coalesce(below, F.lit(False))


def is_meaningful(listen: Column, duration: Column) -> Column:
    """True when at least a fifth of the track was heard; unknown durations give False."""
    return F.coalesce(_reaches(listen, duration, fixed.MEANINGFUL_SHARE), F.lit(False))


def is_meaningful_play(listen: Column, duration: Column) -> Column:
    return is_meaningful(listen, duration).cast("int")


def play_category(listen: Column, duration: Column) -> Column:
    """An unmatched track has no duration, so its plays fall through to the last label."""
    return (
        F.when(is_abandoned(listen), fixed.ABANDONED)
        .when(is_skipped(listen, duration), fixed.SKIPPED)
        .when(~_reaches(listen, duration, fixed.PARTIAL_SHARE), fixed.PARTIAL)
        .otherwise(fixed.COMPLETED)
    )


def duration_flag(duration: Column) -> Column:
    return (
        F.when(duration < fixed.DURATION_LOW_BELOW, "low")
        .when(duration <= fixed.DURATION_MEDIUM_UPTO, "medium")
        .otherwise("high")
    )


def clean_name(name: Column) -> Column:
    return F.regexp_replace(name, "-", "")


def tier(
    score: Column,
    cuts: Sequence[tuple[str, int]] = fixed.TIER_CUTS,
    floor: str = fixed.TIER_FLOOR,
) -> Column:
    """Best tier whose cut the score reaches. ``cuts`` run from best to worst."""
    reached = [F.when(score >= cut, F.lit(label)) for label, cut in cuts]
    return F.coalesce(*reached, F.lit(floor))
