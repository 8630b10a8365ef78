"""Parts of a published table by a hash of its key, as many as the table has grown to.

Linear hashing: with n buckets and L the largest power of two up to n, a key lies in bucket ``hash mod 2L`` if that is
below n, else in the one L lower. Bucket n then splits off bucket n - L, and from no other: a table grows one
bucket at a time, and a batch rewrites the buckets of its keys and those that are due to split. The commit
holds the number of buckets and rows, which is all that finding a key's bucket takes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.sources.snapshot import PART, Commit, SnapshotTable

# rows of a bucket on average, at most: some ten megabytes
PER_BUCKET = 200_000
BUCKETS, ROWS = "buckets", "rows"


def bucket(keys: Sequence[str], count: int) -> Column:
    """Number of the bucket, of ``count`` ones, that holds a key. Missing keys are one key."""
    low = 1 << (count.bit_length() - 1)
    wide = F.pmod(F.xxhash64(*keys), F.lit(2 * low))
    return F.when(wide < count, wide).otherwise(wide - low)


def parents(count: int, grown: int) -> set[int]:
    """The buckets of ``count`` whose keys move when there are ``grown``."""
    out = set()
    for new in range(count, grown):
        while new >= count:
            new -= 1 << (new.bit_length() - 1)
        out.add(new)
    return out


@dataclass(frozen=True)
class Buckets:
    """What one batch does to the buckets of a table.

    ``names`` are the parts that the batch reads and replaces: those of its keys, and those due to split.
    """

    table: SnapshotTable
    head: Commit
    keys: tuple[str, ...]
    prefix: str
    count: int
    names: list[str]

    @staticmethod
    def touched(
        table: SnapshotTable, head: Commit, batch: DataFrame, keys: Sequence[str], prefix: str = "",
        per_bucket: int = PER_BUCKET, before: int = 0, others: Sequence[str] = (),
    ) -> Buckets:
        """The buckets of a batch. Tables of an earlier layout have ``before`` buckets, or none and all rows in parts
        that are not among ``others``: those are then taken in whole, once."""
        keys, known = tuple(keys), {p for p in head.parts if p not in others}
        now = head.facts.get(BUCKETS, before if known else 0)
        if now:
            rows = head.facts.get(ROWS)
            rows = table.read(known, head).count() if rows is None else rows
            hit = {row[0] for row in batch.select(bucket(keys, now)).distinct().collect()}
        else:
            # the batch as a whole, or all there is
            rows, hit = batch.count() + (table.read(known, head).count() if known else 0), set()
        count = max(now, -(-rows // per_bucket), 1)
        names = {f"{prefix}{b}" for b in hit | parents(now, count)} if now else known
        return Buckets(table, head, keys, prefix, count, sorted(names & known))

    def read(self) -> DataFrame:
        return self.table.read(self.names, self.head)

    def part(self) -> Column:
        """The part that a row of the batch's result belongs to."""
        return F.concat(F.lit(self.prefix), bucket(self.keys, self.count).cast("string"))

    def facts(self, written: DataFrame) -> dict[str, int]:
        """What the commit has to know, counted in the files written and replaced."""
        own = written.where(F.col(PART).startswith(self.prefix)) if self.prefix else written
        before = {p for p in self.head.parts if p.startswith(self.prefix)}
        kept = self.head.facts.get(ROWS)
        if kept is None:
            kept = self.table.read(before, self.head).count() if before else 0
        gone = self.read().count() if self.names else 0
        return {BUCKETS: self.count, ROWS: kept - gone + own.count()}
