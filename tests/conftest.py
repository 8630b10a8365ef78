from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from listenlake import session

    spark = session.build(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            # keep small frames in several partitions, as large ones are
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path)
