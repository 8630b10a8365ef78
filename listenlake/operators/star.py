"""Left-join denormalisation driven by a list of join specs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JoinSpec:
    """One table of a star: its alias, the columns it adds, and how it hangs on the tables before.

    The first spec of a list is the root and has no condition. ``spread_by`` names columns that tell its rows apart,
    by which salted rows are dealt; without it, all columns do, and all are moved.
    """

    table: DataFrame
    alias: str
    cols: Sequence[str | Column]
    condition: str | Column | None = None
    salted_on: tuple[str, str] | None = None
    spread_by: Sequence[str] = ()


def star_join(specs: Sequence[JoinSpec], hot_share: float | None = None) -> DataFrame:
    """Root left-joined to every further table, columns in spec order.

    No broadcast hints: Spark broadcasts a table only after checking its size (statically and,
    with adaptive execution, once more at run time) and sorts and merges otherwise. A spec with
    ``salted_on``, the root's column and its own that its condition sets equal, has the root's
    frequent and missing keys dealt over all shuffle partitions first: those that hold more than
    ``hot_share`` of the rows, by default more than the mean partition.
    """
    root, *others = specs
    if root.condition is not None or any(s.condition is None for s in others):
        raise ValueError("the first table has no condition and every other one needs one")
    joined = root.table.alias(root.alias)
    salted = list(dict.fromkeys(s.salted_on[0] for s in others if s.salted_on))
    if salted:
        # one pass for all keys
        hot = hot_keys(root.table, salted, hot_share if hot_share is not None else default_hot_share(root.table))
    spread_by = [F.col(f"{root.alias}.{c}") for c in root.spread_by or root.table.columns]
    for spec in others:
        on = F.expr(spec.condition) if isinstance(spec.condition, str) else spec.condition
        table = spec.table
        if spec.salted_on:
            key, own = spec.salted_on
            salts = int(root.table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            salt, copies = salting(F.col(f"{root.alias}.{key}"), F.col(own), hot[key], spread_by, salts)
            table = table.withColumn("_dim_salt", F.explode(copies))
            on &= F.col(f"{spec.alias}._dim_salt") == salt
        joined = joined.join(table.alias(spec.alias), on, "left")
    return joined.select(*[c for spec in specs for c in spec.cols])


def default_hot_share(df: DataFrame) -> float:
    """A key with more rows than the mean shuffle partition is hot; a hundred thousand keys at most are."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(1 / parts, 1e-5), 0.01)


def salting(
    fact_key: Column, dim_key: Column, hot: Sequence, spread_by: Sequence[str | Column], salts: int
) -> tuple[Column, Column]:
    """The salt of a fact row, and the salts under which a dimension row is repeated.

    A missing key matches nothing wherever it goes, but all of them would go to one task.
    """
    spread_out, repeat = fact_key.isNull(), F.lit(False)
    if hot:
        spread_out |= fact_key.isin(hot)
        repeat = dim_key.isin(hot)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = F.when(repeat, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return F.when(spread_out, salt).otherwise(0), copies


def hot_keys(df: DataFrame, cols: Sequence[str], support: float = 0.01) -> dict[str, list]:
    """Every value holding more than ``support`` of the rows, per column.

    Spark's one-pass frequent-item sketch: it never misses such a value and returns at most about
    ``1 / support`` values per column, so what reaches the driver is bounded. It may name a few
    values that are less frequent, which costs a little salting and no correctness.
    """
    found = df.freqItems(list(cols), support).first()
    return {c: [v for v in found[f"{c}_freqItems"] if v is not None] for c in cols}


def left_join_salted(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    hot: Iterable,
    spread_by: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """Left join in which hot keys and missing keys are spread over ``salts`` shuffle keys.

    There are as many salts as shuffle partitions unless told otherwise, so a key with a third of
    all rows reaches every partition. Only the dimension rows of hot keys are repeated
    (``len(hot) * salts`` rows for a dimension with unique keys); the fact keeps one row per row.
    The salt is a hash of row values, so a retried task deals out the same salts.
    """
    hot = list(hot)
    salts = salts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt, copies = salting(F.col(fact_key), F.col(dim_key), hot, spread_by, salts)
    salted = fact.withColumn("_salt", salt)
    repeated = dim.withColumn("_dim_salt", F.explode(copies))
    on = (salted[fact_key] == repeated[dim_key]) & (salted["_salt"] == repeated["_dim_salt"])
    return salted.join(repeated, on, "left").drop("_salt", "_dim_salt")
