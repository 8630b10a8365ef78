"""Expressions the KPI tables are made of.

The aggregate is declarative with a fixed-width buffer, so Spark combines it on the map side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600


def flagged(condition: Column) -> Column:
    """Rows for which the condition holds, 0 (not null) when there are none."""
    return F.count_if(condition)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)
