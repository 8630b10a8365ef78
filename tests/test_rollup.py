"""KPI tables from kept sums against the full refresh, after late, moved and deleted plays and changed dimensions."""

import random

import pytest

from listenlake.plans import rollup
from listenlake.plans.kpi import KPIS
from listenlake.plans.star import Star
from listenlake.sources.snapshot import PART, SnapshotTable

PLAY = "stream_id long, user_id long, track_id long, date_key int, listen_duration int, device_type string"
USER = "user_sk long, user_id long, user_name string, country string, subscription_type string"
TRACK = "track_id long, track_sk long, track_name string, album_name string, artist_id long, duration_sec int"
ARTIST = "artist_id long, artist_sk int, artist_name string, genre string, country string"
DATE = "date_key int, date date, day int, month int, year int, weekday string"


def plays(seed, ids, months=(1, 2, 3, 4)):
    draw = random.Random(seed)
    users = [*range(1, 30), 10**15, -4, None]
    return [
        (i, draw.choice(users), draw.choice([*range(12), None, 99]), 20240000 + 100 * draw.choice(months) + 1, draw.choice([None, 0, 3, 40, 200]), draw.choice(["tv", "phone", None]))
        for i in ids
    ]


class Shop:
    """A small star whose tables can be replaced."""

    def __init__(self, spark, root):
        self.spark, self.root, self.batch = spark, root, 0
        self.facts = SnapshotTable(spark, f"{root}/facts", PLAY)
        self.rows = {}
        self.plans = {u: ["Free", "Premium"][u % 2] for u in range(1, 25)}
        self.durations = {t: [100, 200, None][t % 3] for t in range(10)}
        self.names = "t"

    def publish(self, rows):
        """Put plays in, in place of those of the same id."""
        parts = {str(self.rows[r[0]][3])[:6] for r in rows if r[0] in self.rows} | {str(r[3])[:6] for r in rows}
        self.rows |= {r[0]: r for r in rows}
        now = [(*r, str(r[3])[:6]) for r in self.rows.values() if str(r[3])[:6] in parts]
        self.facts.publish(self.spark.createDataFrame(now, f"{PLAY}, {PART} string"), self.batch, replaces=parts)
        self.batch += 1
        return sorted(parts)

    def star(self):
        frame = self.spark.createDataFrame
        return Star(
            lambda: frame([*self.rows.values()], PLAY),
            lambda: frame([(u, u, f"u{u}", "NL", p) for u, p in self.plans.items()], USER),
            lambda: frame([(t, t, f"{self.names}{t}", "a", t % 4, d) for t, d in self.durations.items()], TRACK),
            lambda: frame([(a, a, f"a{a}", ["pop", "rock", None][a % 3], "NL") for a in range(4)], ARTIST),
            lambda: frame([(20240000 + 100 * m + 1, None, 1, m, 2024, "1") for m in range(1, 5)], DATE),
        )

    def state(self):
        return rollup.KpiState(self.spark, self.facts, self.star(), f"{self.root}/state", per_bucket=10)

    def check(self):
        state, star = self.state(), self.star()
        for name, kpi in KPIS.items():
            kept, full = (sorted(map(repr, df.collect())) for df in (state.kpi(name), kpi(star)))
            assert kept == full and kept, name


def test_kept_sums_equal_a_full_refresh(spark, root):
    shop = Shop(spark, root)
    shop.publish(plays(1, range(300)))
    read = shop.state().refresh()
    assert all(parts == ["202401", "202402", "202403", "202404"] for parts in read.values())
    shop.check()
    assert all(parts == [] for parts in shop.state().refresh().values())

    # late plays, new users among them, and plays that move from one month to another: only these are read
    touched = shop.publish([*plays(2, range(300, 330), months=(2,)), *[(i, 77, 3, 20240201, 50, "tv") for i in range(400, 410)]])
    assert touched == ["202402"] and all(parts == touched for parts in shop.state().refresh().values())
    moved = [(*r[:3], 20240301, *r[4:]) for r in shop.rows.values() if str(r[3])[:6] in ("202402", "202403")][:40]
    touched = shop.publish(moved)
    assert touched == ["202402", "202403"] and all(parts == touched for parts in shop.state().refresh().values())
    shop.check()

    # numbers of users stay, and are dense
    numbers = {r.user_id: r.user_no for r in shop.state().numbers.read().collect()}
    assert sorted(numbers.values()) == list(range(1, len(numbers) + 1)) and {77, 10**15, -4} <= set(numbers)

    # a plan matters to the tables by plan only, a duration to those that hold plays against it, a name to none but the tracks'
    shop.plans[3] = "Family"
    read = shop.state().refresh()
    assert {n for n, parts in read.items() if parts} == {"genre_subscription_kpi", "device_subscription_kpi"}
    shop.durations[4] = 400
    read = shop.state().refresh()
    assert {n for n, parts in read.items() if not parts} == {"device_subscription_kpi"}
    shop.check()


def test_a_part_that_is_gone_takes_its_sums_along(spark, root):
    shop = Shop(spark, root)
    shop.publish(plays(3, range(120)))
    shop.state().refresh()
    shop.rows = {i: r for i, r in shop.rows.items() if str(r[3])[:6] != "202403"}
    shop.facts.publish(spark.createDataFrame([], f"{PLAY}, {PART} string"), shop.batch, replaces=["202403"])
    assert all(parts == [] for parts in shop.state().refresh().values())
    shop.check()
    # the month comes back as it was
    shop.batch += 1
    shop.publish(plays(3, range(500, 520), months=(3,)))
    assert all(parts == ["202403"] for parts in shop.state().refresh().values())
    shop.check()


def test_a_broken_refresh_is_taken_up(spark, root, monkeypatch):
    shop = Shop(spark, root)
    shop.publish(plays(4, range(150)))
    real, done = SnapshotTable.publish, []

    def publish(self, *args, **kwargs):
        if "/state/" in self.root:
            done.append(self.root)
            if len(done) == 3:
                raise RuntimeError("lost")
        return real(self, *args, **kwargs)

    monkeypatch.setattr(SnapshotTable, "publish", publish)
    with pytest.raises(RuntimeError):
        shop.state().refresh()
    monkeypatch.setattr(SnapshotTable, "publish", real)
    read = shop.state().refresh()
    assert [bool(parts) for parts in read.values()] == [False, True, True, True, True]
    shop.check()
    # no plays at all: empty tables, no error
    empty = Shop(spark, f"{root}/empty")
    empty.facts.publish(spark.createDataFrame([], f"{PLAY}, {PART} string"), 0)
    empty.state().refresh()
    assert all(empty.state().kpi(name).count() == 0 for name in KPIS)
