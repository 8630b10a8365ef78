"""The listening star: one fact and four dimensions, and its wide view."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.functions import plays
from listenlake.operators.sizes import BROADCAST_BYTES, fits_broadcast
from listenlake.operators.star import default_hot_share, hot_keys, left_join_salted

Opener = Callable[[], DataFrame]

DIMS = ("user", "track", "artist", "date")

# The columns of the wide view in the order that its readers rely on.
WIDE_COLS = (
    "stream_id", "user_sk", "track_sk", "artist_sk", "user_id", "track_id", "artist_id", "listen_duration",
    "duration_sec", "is_meaningful_play", "play_category", "user_name", "user_country", "subscription_type",
    "device_type", "track_name", "album_name", "artist_name", "genre", "artist_country", "date_key", "date", "day",
    "month", "year", "weekday",
)


class Star:
    """Current silver tables. Every dimension holds one row per key, which silver guarantees.

    Tables are given as functions and opened when a query first needs them. How the fact meets a
    dimension is decided by measurement, once per star: one that fits ``broadcast_bytes`` is
    broadcast, so the fact is not moved at all. A larger one is joined by shuffle, with the fact
    keys that hold more than ``hot_share`` of its rows salted: by default those that hold more
    than the mean shuffle partition, but no more than a hundred thousand keys.
    """

    def __init__(
        self,
        fact: Opener,
        user: Opener,
        track: Opener,
        artist: Opener,
        date: Opener,
        broadcast_bytes: int = BROADCAST_BYTES,
        hot_share: float | None = None,
    ):
        self._open = {"fact": fact, "user": user, "track": track, "artist": artist, "date": date}
        self.broadcast_bytes = broadcast_bytes
        self.hot_share = hot_share
        self._fits: dict[str, bool] = {}
        self._hot: dict[str, list] = {}

    @cached_property
    def fact(self) -> DataFrame:
        return self._open["fact"]()

    @cached_property
    def user(self) -> DataFrame:
        return self._open["user"]()

    @cached_property
    def track(self) -> DataFrame:
        return self._open["track"]()

    @cached_property
    def artist(self) -> DataFrame:
        return self._open["artist"]()

    @cached_property
    def date(self) -> DataFrame:
        return self._open["date"]()

    def fits(self, name: str, dim: DataFrame) -> bool:
        if name not in self._fits:
            self._fits[name] = fits_broadcast(dim, self.broadcast_bytes)
        return self._fits[name]

    def _share(self) -> float:
        return default_hot_share(self.fact) if self.hot_share is None else self.hot_share

    def hot(self, *keys: str) -> list[list]:
        """Hot values of every key; those not known yet are found by one pass over the fact."""
        unknown = {key: {"f_date_key": "date_key"}.get(key, key) for key in keys if key not in self._hot}
        if unknown:
            found = hot_keys(self.fact, [*unknown.values()], self._share())
            self._hot |= {key: found[name] for key, name in unknown.items()}
        return [self._hot[key] for key in keys]


def _prefixed(dim: DataFrame, prefix: str, cols: Sequence[str]) -> DataFrame:
    return dim.select(*[F.col(c).alias(prefix + c) for c in cols])


def _attach(
    star: Star, wide: DataFrame, name: str, dim: DataFrame, key: str, dim_key: str
) -> DataFrame:
    if star.fits(name, dim):
        return wide.join(F.broadcast(dim), F.col(key) == F.col(dim_key), "left")
    (hot,) = star.hot(key)
    return left_join_salted(wide, dim, key, dim_key, hot, spread_by=["f_stream_id"])


def tracks_with_artist(star: Star) -> DataFrame:
    """The snowflake arm folded once, dimension to dimension, so the fact is joined to one table.

    ``(fact left join track) left join artist`` equals ``fact left join (track left join
    artist)``, since the artist condition cannot hold where the track is missing.
    """
    track = _prefixed(
        star.track,
        "t_",
        ["track_id", "track_sk", "track_name", "album_name", "artist_id", "duration_sec"],
    )
    artist = _prefixed(
        star.artist, "a_", ["artist_id", "artist_sk", "artist_name", "genre", "country"]
    )
    return track.join(artist, F.col("t_artist_id") == F.col("a_artist_id"), "left")


def base_fact(star: Star, dims: Sequence[str] = DIMS, extra: Sequence[str] = ()) -> DataFrame:
    """One row per fact row with the columns of the asked dimensions, and ``extra`` columns of the fact.

    Leaving a dimension out leaves its columns out. That is safe because a left join on a unique
    key neither drops nor repeats fact rows.
    """
    unknown = set(dims) - set(DIMS)
    if unknown:
        raise ValueError(f"unknown dimensions: {sorted(unknown)}")
    facts = _prefixed(
        star.fact,
        "f_",
        ["stream_id", "user_id", "track_id", "date_key", "listen_duration", "device_type", *extra],
    )
    listen, duration = F.col("f_listen_duration"), F.col("t_duration_sec")
    out = {
        "stream_id": F.col("f_stream_id"),
        "user_id": F.col("user_id"),
        "listen_duration": listen,
        "device_type": F.col("f_device_type"),
    }
    wide = facts.withColumnsRenamed({"f_user_id": "user_id", "f_track_id": "track_id"})
    arms = []
    if "user" in dims:
        user = _prefixed(
            star.user, "u_", ["user_sk", "user_id", "user_name", "country", "subscription_type"]
        )
        arms.append(("user", user, "user_id", "u_user_id"))
        out |= {
            "user_sk": F.col("u_user_sk"),
            "user_name": F.col("u_user_name"),
            "user_country": F.col("u_country"),
            "subscription_type": F.col("u_subscription_type"),
        }
    if "track" in dims or "artist" in dims:
        arm, name = (tracks_with_artist(star), "artist") if "artist" in dims else (
            _prefixed(
                star.track,
                "t_",
                ["track_id", "track_sk", "track_name", "album_name", "duration_sec"],
            ),
            "track",
        )
        arms.append((name, arm, "track_id", "t_track_id"))
        out |= {
            "track_sk": F.col("t_track_sk"),
            "track_id": F.col("t_track_id"),
            "duration_sec": duration,
            "is_meaningful_play": plays.is_meaningful_play(listen, duration),
            "play_category": plays.play_category(listen, duration),
            "track_name": F.col("t_track_name"),
            "album_name": F.col("t_album_name"),
        }
    if "artist" in dims:
        out |= {
            "artist_sk": F.col("a_artist_sk"),
            "artist_id": F.col("a_artist_id"),
            "artist_name": F.col("a_artist_name"),
            "genre": F.col("a_genre"),
            "artist_country": F.col("a_country"),
        }
    if "date" in dims:
        calendar = ["date_key", "date", "day", "month", "year", "weekday"]
        date = _prefixed(star.date, "d_", calendar)
        arms.append(("date", date, "f_date_key", "d_date_key"))
        out |= {c: F.col(f"d_{c}") for c in calendar}
    # the keys of all arms that are joined by shuffle are looked at together
    star.hot(*[key for name, dim, key, _ in arms if not star.fits(name, dim)])
    for arm in arms:
        wide = _attach(star, wide, *arm)
    more = [F.col(f"f_{c}").alias(c) for c in extra]
    return wide.select(*[out[name].alias(name) for name in WIDE_COLS if name in out], *more)
