"""Tables published as immutable versions.

Plain Parquet has no transactional merge, so a batch writes new folders and then commits one small
entry naming all folders that now make up the table. Readers see the old or the new table, never a
mix. A commit carries its batch number, which makes a replayed batch a no-op. Folders are kept per
part, and a commit replaces only the parts it rewrote.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from listenlake.sources import fs
from listenlake.sources.partfilters import FILTER_DDL, PART, part_filters, parts_that_may_hold
from listenlake.sources.state import StateLog


@dataclass(frozen=True)
class Commit:
    version: int
    batch_id: int
    parts: Mapping[str, list[str]]
    facts: Mapping[str, int] = field(default_factory=dict)
    stream: str | None = None
    filters: Mapping[str, list[str]] = field(default_factory=dict)


class OtherStream(RuntimeError):
    """A batch of a stream with another checkpoint than the one that fed the table so far."""


NOTHING = Commit(version=0, batch_id=-1, parts={})


class SnapshotTable:
    """``schema`` leaves out the part column, which only names folders; without one, files tell it.

    With a ``key``, every commit keeps a filter of the keys of each part beside the data (see ``parts_of``).
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str | None = None, key: str | None = None):
        self.spark = spark
        self.key = key
        self.root = root.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.log = StateLog(spark, f"{self.root}/_commits")

    def head(self) -> Commit:
        entry = self.log.latest()
        return Commit(**entry) if entry else NOTHING

    def applied(self, head: Commit, batch_id: int, stream: str | None = None) -> bool:
        """Whether ``head`` holds the batch already.

        Batch numbers begin anew with every checkpoint, so they are compared only for one ``stream``.
        """
        if stream and head.stream and stream != head.stream:
            raise OtherStream(f"{self.root} is fed by stream {head.stream}; batch {batch_id} is of {stream}")
        return head.batch_id >= batch_id

    def done(self, batch_id: int) -> bool:
        return self.applied(self.head(), batch_id)

    def read(self, parts: Iterable[str] | None = None, head: Commit | None = None) -> DataFrame:
        """The table as committed, or some parts of it."""
        head = head or self.head()
        wanted = head.parts if parts is None else set(parts) & set(head.parts)
        paths = [f"{self.root}/{p}" for part in sorted(wanted) for p in head.parts[part]]
        if self.schema is None:
            if not paths:
                raise FileNotFoundError(f"{self.root} has no version yet")
            return self.spark.read.parquet(*paths)
        if not paths:
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            return self.spark.range(0).select(*nulls)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _named(self, rows: DataFrame) -> DataFrame:
        """Rows with their part, which names the folder of their file."""
        folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
        return rows.select("*", F.url_decode(F.element_at(F.split(folder, "="), -1)).alias(PART))

    def parted(self, parts: Iterable[str] | None = None, head: Commit | None = None) -> DataFrame:
        """As ``read``, with the part of each row."""
        head = head or self.head()
        if not (head.parts if parts is None else set(parts) & set(head.parts)):
            return self.read([], head).withColumn(PART, F.lit(""))
        return self._named(self.read(parts, head))

    def parts_of(self, keys: DataFrame, head: Commit) -> list[str]:
        """Parts that may hold a key of the frame, which has to be small; parts without a filter are among them."""
        paths = [f"{self.root}/{p}" for found in head.filters.values() for p in found]
        unknown = [p for p in head.parts if p not in head.filters]
        if not paths:
            return unknown
        filters = self._named(self.spark.read.schema(FILTER_DDL).parquet(*paths))
        return unknown + parts_that_may_hold(filters, keys, self.key)

    def publish(
        self,
        rows: DataFrame,
        batch_id: int,
        replaces: Iterable[str] | None = None,
        facts: Callable[[DataFrame], Mapping[str, int]] = lambda written: {},
        head: Commit | None = None,
        rebalance: bool = False,
        stream: str | None = None,
    ) -> Commit:
        """Write ``rows``, which carry a ``part`` column, and commit.

        Parts in ``replaces`` lose their old folders (all parts if it is None); the other parts
        keep theirs and gain the new rows. ``facts`` is asked once the rows are written, and gets them as
        they lie in the files, with their part; what it gives is kept with this commit and later ones. ``rebalance`` is for many parts: it costs
        a shuffle, which gathers small parts into few files and splits parts that are too large.
        """
        head = head or self.head()
        # a folder of its own: two writers that start from one head don't touch each other's rows,
        # and only the first one's commit is taken
        folder = f"data/v={head.version + 1:08d}-{uuid.uuid4().hex[:12]}"
        target = f"{self.root}/{folder}"
        names = [f.name for f in self.schema]
        sized = rows.select(*names, PART)
        if rebalance:
            sized = sized.hint("rebalance", F.col(PART))
        sized.write.mode("overwrite").partitionBy(PART).parquet(target)
        dropped = set(head.parts) if replaces is None else {str(p) for p in replaces}
        parts = self._placed(head.parts, dropped, folder)
        # names of parts stay text, whatever they look like
        written = self.spark.read.schema(StructType([*self.schema, StructField(PART, StringType())])).parquet(target)
        filters = {}
        if self.key:
            made = folder.replace("data/", "filters/")
            found = part_filters(written.select(PART, self.key), self.key)
            found.write.mode("overwrite").partitionBy(PART).parquet(f"{self.root}/{made}")
            filters = self._placed(head.filters, dropped, made)
        known = {**head.facts, **facts(written)}
        commit = Commit(head.version + 1, batch_id, parts, known, stream or head.stream, filters)
        self.log.append(json.loads(json.dumps(commit.__dict__)), commit.version)
        return commit

    def _placed(self, before: Mapping[str, list[str]], dropped: set[str], folder: str) -> dict[str, list[str]]:
        """The folders of each part after a version: those of the parts that are not dropped, and the new ones."""
        parts = {p: list(paths) for p, paths in before.items() if p not in dropped}
        prefix = f"{PART}="
        for name in fs.children(self.spark, f"{self.root}/{folder}"):
            if name.startswith(prefix):
                parts.setdefault(name[len(prefix) :], []).append(f"{folder}/{name}")
        return parts

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete data folders that none of the newest ``keep`` commits names.

        Readers of older versions must be done. Folders of a write in progress have a higher
        version than any commit and stay.
        """
        kept = [Commit(**entry) for entry in self.log.recent(keep)]
        if not kept:
            return []
        named = {path for commit in kept for held in (commit.parts, commit.filters) for paths in held.values() for path in paths}
        gone = []
        for top in ("data", "filters"):
            for version in fs.children(self.spark, f"{self.root}/{top}"):
                if int(version.removeprefix("v=").partition("-")[0]) > kept[0].version:
                    continue
                for part in fs.children(self.spark, f"{self.root}/{top}/{version}"):
                    path = f"{top}/{version}/{part}"
                    if part.startswith(f"{PART}=") and path not in named:
                        fs.delete(self.spark, f"{self.root}/{path}")
                        gone.append(path)
        return gone
