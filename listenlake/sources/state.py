"""Small persisted state: numbered JSON entries in a folder, of which the newest counts.

Used for watermarks, remembered schemas and table commits. An entry is one text file in a folder
of its own; it exists once Spark has marked that folder complete, so a crash in the middle leaves
the entry before it in force.

A log has one writer at a time, as has a table that commits to it: an entry that is there is never written over, but
nothing keeps two writers from looking at the same instant. One stream with one checkpoint per table sees to that.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from listenlake.sources import fs


class Conflict(RuntimeError):
    """Another writer has taken the number that this one was to write."""


class StateLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _numbers(self) -> list[int]:
        return [int(n) for n in fs.children(self.spark, self.root) if n.isdigit()]

    def _path(self, number: int) -> str:
        return f"{self.root}/{number:012d}"

    def _newest(self) -> int | None:
        for number in reversed(self._numbers()):
            if fs.exists(self.spark, f"{self._path(number)}/_SUCCESS"):
                return number
        return None

    def recent(self, count: int) -> list[dict]:
        """The newest entries, newest first."""
        done = [
            n for n in reversed(self._numbers()) if fs.exists(self.spark, f"{self._path(n)}/_SUCCESS")
        ]
        texts = (self.spark.read.text(self._path(n), wholetext=True) for n in done[:count])
        return [json.loads(text.first()[0]) for text in texts]

    def latest(self) -> dict | None:
        newest = self._newest()
        if newest is None:
            return None
        return json.loads(self.spark.read.text(self._path(newest), wholetext=True).first()[0])

    def append(self, fields: dict, number: int | None = None) -> None:
        """Write the next entry, or entry ``number``; a finished entry is never written over."""
        number = number or (self._newest() or 0) + 1
        if fs.exists(self.spark, f"{self._path(number)}/_SUCCESS"):
            raise Conflict(f"{self._path(number)} has been written already")
        entry = self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(fields)).alias("value"))
        entry.write.mode("overwrite").text(self._path(number))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream a checkpoint belongs to: new with a new checkpoint, then the same for good."""
    log = StateLog(spark, f"{checkpoint}/stream-id")
    if log.latest() is None:
        log.append({"id": uuid.uuid4().hex})
    return log.latest()["id"]
