"""Compare a named query with its SQL, run by DuckDB over the same files.

As a script: ``python tests/oracle.py <sf dir> [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows(columns, data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(table, key=repr)


def compare(spark, run, sql: str, sf_dir: str) -> str:
    """Empty when both agree, else what differs first."""
    df = run(spark, sf_dir)
    got_cols, got = rows(df.columns, df.collect())
    con = connect(sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want_cols, want = rows(names, result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    spark_kinds = dict(df.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
            "timestamp": "TIMESTAMP"}
    odd = [(c, spark_kinds[c], kinds[c]) for c in got_cols if same.get(spark_kinds[c]) != kinds[c]]
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} != {b}"
    return ""


def main() -> int:
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from listenlake import registry, session

    sf_dir, *names = sys.argv[1:]
    spark = session.build(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                 "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in names or queries:
        begun = time.time()
        try:
            problem = compare(spark, queries[name], sqls[name], sf_dir) if name in sqls else (
                f"rows only: {queries[name](spark, sf_dir).count()}")
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - begun:.2f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
