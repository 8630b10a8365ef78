"""Named queries over the sample tables, and the SQL each must agree with."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from listenlake.registry import gold, history, ingest, quality

PARTS = (gold, quality, history, ingest)


def _wall_clock(run):
    """Times as the plain date-times they were in the tables, whatever the session's time zone."""

    @wraps(run)
    def wrapped(spark, sf_dir):
        df = run(spark, sf_dir)
        times = [f.name for f in df.schema if f.dataType == TimestampType()]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df

    return wrapped


def queries() -> dict:
    return {name: _wall_clock(run) for part in PARTS for name, run in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
