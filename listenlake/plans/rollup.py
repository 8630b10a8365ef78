"""KPI tables from sums that are kept per part of the fact.

The sums of a KPI table add up over parts of the fact, but its numbers of users do not: for those, the set of
users is kept. Groups with many users (per genre, device or month) hold theirs as bitmaps over dense user numbers, which
are dealt once and stay; groups with few (per track) as one row per user. Both merge exactly. So a refresh reads
the parts of the fact that were written since the last one, whatever came late or moved, and merges the rest.

The sums depend on some columns of the dimensions. A digest of these is kept as well; where it has changed, the
table's sums are made anew from all parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.operators.durable import materialise
from listenlake.operators.keys import assign_sk
from listenlake.operators.sizes import fits_broadcast
from listenlake.plans.kpi import KPIS, USERS, Kpi
from listenlake.plans.star import Star
from listenlake.sources.buckets import PER_BUCKET, Buckets
from listenlake.sources.snapshot import PART, Commit, SnapshotTable

# tables whose groups have so many users that their sets are bitmaps; the others keep a row per user
BITMAPS = ("genre_subscription_kpi", "device_subscription_kpi", "monthly_trend_kpi")
USER, NUMBER, BUCKET, BITS = "user_id", "user_no", "user_bucket", "user_bits"
HIGHEST, DIMENSIONS = "highest", "dimensions"


def _digest(*values) -> int:
    return zlib.crc32(repr(values).encode())


class KpiState:
    """The kept sums of all KPI tables, in folders below ``root``.

    ``facts`` is the published fact; ``star`` has it and the current dimensions.
    """

    def __init__(self, spark: SparkSession, facts: SnapshotTable, star: Star, root: str, per_bucket: int = PER_BUCKET):
        self.spark, self.facts, self.star, self.root, self.per_bucket = spark, facts, star, root, per_bucket
        self.numbers = SnapshotTable(spark, f"{root}/user_numbers", f"{USER} bigint, {NUMBER} bigint")

    def _table(self, name: str, schema=None) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}", schema)

    def _needs(self, kpi: Kpi) -> int:
        """Digest of the dimension columns that a KPI's sums depend on, whatever the order of their rows."""
        found = []
        for name, columns in kpi.needs.items():
            rows = getattr(self.star, name).select(F.xxhash64(*columns).alias("h"))
            low = F.col("h").bitwiseAND(F.lit((1 << 31) - 1))
            found.append((name, *rows.agg(F.count(F.lit(1)), F.bit_xor("h"), F.sum(low)).first()))
        return _digest(*found)

    def _stale(self, head: Commit, known: Commit, needs: int) -> tuple[list[str], list[str]]:
        """Parts of the fact whose sums have to be made, and parts whose sums have to go."""
        made = {p: _digest(*paths) for p, paths in head.parts.items()}
        if known.facts.get(DIMENSIONS) != needs:
            return sorted(made), sorted(known.parts)
        fresh = {p for p, d in made.items() if known.facts.get(f"part {p}") != d}
        return sorted(fresh), sorted(p for p in known.parts if p in fresh or p not in made)

    def _number(self, facts: DataFrame) -> None:
        """Deal numbers to the users of some facts that have none yet."""
        head = self.numbers.head()
        users = materialise(facts.where(F.col(USER).isNotNull()).select(USER).distinct(), "users")
        if users.isEmpty():
            return
        buckets = Buckets.touched(self.numbers, head, users, [USER], per_bucket=self.per_bucket)
        known, start = buckets.read(), head.facts.get(HIGHEST, 0)
        dealt = assign_sk(users.join(known, USER, "left_anti"), [USER], NUMBER, start)

        def facts_of(written: DataFrame) -> dict[str, int]:
            highest = written.agg(F.max(NUMBER)).first()[0]
            return {HIGHEST: max(start, highest or 0), **buckets.facts(written)}

        rows = known.unionByName(dealt.select(known.columns)).withColumn(PART, buckets.part())
        self.numbers.publish(rows, head.batch_id + 1, replaces=buckets.names, facts=facts_of, head=head)

    def _sums(self, name: str, kpi: Kpi, parts: list[str], head: Commit) -> DataFrame:
        star = Star(
            lambda: self.facts.parted(parts, head),
            *(lambda n=n: getattr(self.star, n) for n in ("user", "track", "artist", "date")),
            broadcast_bytes=self.star.broadcast_bytes, hot_share=self.star.hot_share,
        )
        # which dimensions fit a broadcast is known already
        star._fits = self.star._fits
        sums = kpi.sums()
        by_user = [PART, *dict.fromkeys([*kpi.keys, *([USER] if kpi.distinct else [])])]
        rows = kpi.plays(star, (PART,)).groupBy(*by_user).agg(*[c.alias(n) for n, c in sums.items()])
        if name not in BITMAPS:
            return rows
        # a user has a row per group at most by now, so none is hot
        numbers = self.numbers.read()
        small = fits_broadcast(numbers, self.star.broadcast_bytes)
        numbered = rows.join(F.broadcast(numbers) if small else numbers, USER, "left")
        return numbered.groupBy(PART, *kpi.keys, F.bitmap_bucket_number(NUMBER).alias(BUCKET)).agg(
            *[F.sum(n).alias(n) for n in sums], F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS)
        )

    def refresh(self, names: Iterable[str] = tuple(KPIS)) -> dict[str, list[str]]:
        """Bring the sums of some tables up to the facts. Returns the parts of the fact read for each of them.

        A refresh that breaks off is taken up by the next one: every table's commit says what its sums are made of.
        """
        head, todo, names = self.facts.head(), {}, list(names)
        for name in names:
            kpi, table = KPIS[name], self._table(name)
            needs = self._needs(kpi)
            known = table.head()
            fresh, gone = self._stale(head, known, needs)
            if fresh or gone or not known.version:
                todo[name] = (kpi, table, needs, known, fresh, gone)
        bitmaps = sorted({p for name, x in todo.items() if name in BITMAPS for p in x[4]})
        if bitmaps:
            self._number(self.facts.read(bitmaps, head))
        for name, (kpi, table, needs, known, fresh, gone) in todo.items():
            sums = self._sums(name, kpi, fresh, head)
            made = {f"part {p}": _digest(*head.parts[p]) for p in fresh} | {f"part {p}": 0 for p in gone if p not in fresh}
            schema = sums.drop(PART).schema
            self._table(name, schema).publish(
                sums, known.batch_id + 1, replaces=gone, facts=lambda written, n=needs, m=made: {DIMENSIONS: n, **m}, head=known
            )
        return {name: todo[name][4] if name in todo else [] for name in names}

    def kpi(self, name: str) -> DataFrame:
        """The KPI table, from the sums alone."""
        kpi, table = KPIS[name], self._table(name)
        head = table.head()
        rows = table.read(head=head) if head.parts else self._sums(name, kpi, [], self.facts.head())
        sums, keys = list(kpi.sums()), list(kpi.keys)
        add = [F.sum(n).alias(n) for n in sums]
        if not kpi.distinct:
            return kpi.finish(self.star, rows.groupBy(*keys).agg(*add))
        if name in BITMAPS:
            each = rows.groupBy(*keys, BUCKET).agg(*add, F.bitmap_count(F.bitmap_or_agg(BITS)).alias(USERS))
            return kpi.finish(self.star, each.groupBy(*keys).agg(*add, F.sum(USERS).alias(USERS)))
        each = rows.groupBy(*keys, USER).agg(*add)
        return kpi.finish(self.star, each.groupBy(*keys).agg(*add, F.count(USER).alias(USERS)))
