"""Declarative row rules: validity flag, first-failure reason, expectations, metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

VALID = "dq_is_valid"
REASON = "dq_fail_reason"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL predicate that is true for a bad row.

    A hard rule makes the row invalid. A soft rule only names a reason.
    """

    reason: str
    fails: str
    hard: bool = True


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the validity flag and the reason: the first failing rule in list order, soft or hard.

    A predicate that is unknown (null) does not fail the row, so the flag is never null.
    """
    reason = F.coalesce(*[F.when(F.expr(r.fails), F.lit(r.reason)) for r in rules])
    broken = [F.coalesce(F.expr(r.fails), F.lit(False)) for r in rules if r.hard]
    valid = ~reduce(lambda a, b: a | b, broken, F.lit(False))
    return df.withColumns({VALID: valid, REASON: reason})


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(VALID)), df.filter(~F.col(VALID))


def count_measures() -> list[Column]:
    return [
        F.count_if(F.col(VALID)).alias("valid_rows"),
        F.count_if(~F.col(VALID)).alias("invalid_rows"),
        F.count_if(F.col(VALID) & F.col(REASON).isNotNull()).alias("soft_failures"),
    ]


def rule_counts(df: DataFrame) -> DataFrame:
    """Valid, invalid and softly failing rows, counted in one pass."""
    return df.agg(*count_measures())


def expect_all_or_drop(
    df: DataFrame, rules: Mapping[str, str], observation: Observation | None = None
) -> DataFrame:
    """Keep the rows for which every named predicate is true; unknown counts as a failure.

    With an observation, the failures per rule are counted while the rows stream past, without a
    pass of their own.
    """
    holds = {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    if observation is not None:
        failed = [F.count_if(~ok).alias(name) for name, ok in holds.items()]
        df = df.observe(observation, *failed)
    return df.filter(reduce(lambda a, b: a & b, holds.values()))


def expect_or_drop(
    df: DataFrame, name: str, rule: str, observation: Observation | None = None
) -> DataFrame:
    return expect_all_or_drop(df, {name: rule}, observation)
