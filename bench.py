"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores.
Each query runs once untimed, so that class loading and code generation do not count, then once
timed with every row and column computed.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from listenlake import registry, session

HEADLINE = (
    "base_fact",
    "genre_subscription_kpi",
    "top_tracks_kpi",
    "device_subscription_kpi",
    "monthly_trend_kpi",
    "user_engagement_kpi",
    "top10_tracks",
    "monthly_growth",
    "user_leaderboard",
    "dq_fact",
    "quarantine_fact",
    "dedup_fact",
    "surrogate_key",
    "scd1_fact",
    "scd2_user",
    "cdc_scd1_track",
    "cdc_scd2_user",
    "incr_all_tables",
    "bronze_ingest",
    "silver_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in HEADLINE:
        run = queries[name]
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        begun = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
