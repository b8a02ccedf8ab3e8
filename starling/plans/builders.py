"""Dimension and fact builders.

The same five tables can be built under four sets of rules, chosen by ``variant``:

``lake``        exact inner match, millisecond timestamps, hashed play id, full overwrite
``warehouse``   case-insensitive inner match, second timestamps, only rows not stored yet
``scheduled``   left match on whole-number durations, second timestamps, whole-row DISTINCT
``relational``  left match with at most one hit, raw epoch milliseconds, first row per key

A builder returns the rows to load: the whole table for ``lake`` and ``scheduled``, the rows to
append to ``existing`` for ``warehouse`` and ``relational``. ``order_by`` decides which row survives
where only one may; the defaults are total orders, so results do not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import drop_fraction, epoch_ms, epoch_s, md5_key, sha2_key, time_parts, try_cast
from ..operators import (
    absent_rows, catalogue, dedup, distinct, match_plays, not_in, only_new, only_plays,
    surrogate_key,
)

VARIANTS = ("lake", "warehouse", "scheduled", "relational")

Order = Iterable[str | Column] | None


def _check(variant: str) -> None:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")


def _not_stored(rows: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    return rows if existing is None else not_in(rows, existing, key)


def _first_per_key(
    existing: DataFrame | None, rows: DataFrame, key: str, order: list
) -> DataFrame:
    # The key of a dimension may not be NULL. A row without one is left for the quality gate to
    # find, and treating NULL as a value spares a second scan of the input.
    return absent_rows(existing, rows, [key], order, nulls_distinct=False)


def build_songs(
    staged_songs: DataFrame,
    existing: DataFrame | None = None,
    variant: str = "lake",
    order_by: Order = None,
    rounding: str = "half_up",
) -> DataFrame:
    """song_id, title, artist_id, year, duration."""
    _check(variant)
    songs = staged_songs.select("song_id", "title", "artist_id", "year", "duration")
    order = list(order_by or ["title", "year", "duration", "artist_id"])
    if variant == "lake":
        return dedup(songs, ["song_id", "artist_id"], order)
    if variant == "warehouse":
        return _not_stored(distinct(songs), existing, "song_id")
    if variant == "scheduled":
        return distinct(songs.withColumn("duration", drop_fraction("duration", rounding)))
    return _first_per_key(existing, songs, "song_id", order)


def build_artists(
    staged_songs: DataFrame,
    existing: DataFrame | None = None,
    variant: str = "lake",
    order_by: Order = None,
    rounding: str = "half_up",
) -> DataFrame:
    """artist_id, name, location, latitude, longitude."""
    _check(variant)

    def position(c: str) -> Column:
        if variant == "scheduled":
            return drop_fraction(try_cast(c, "double"), rounding)
        return try_cast(c, "double")

    artists = staged_songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        position("artist_latitude").alias("latitude"),
        position("artist_longitude").alias("longitude"),
    )
    order = list(order_by or ["name", "location", "latitude", "longitude"])
    if variant == "lake":
        return dedup(artists, ["artist_id"], order)
    if variant == "warehouse":
        return _not_stored(distinct(artists), existing, "artist_id")
    if variant == "scheduled":
        return distinct(artists)
    return _first_per_key(existing, artists, "artist_id", order)


def build_users(
    staged_events: DataFrame,
    existing: DataFrame | None = None,
    variant: str = "lake",
    order_by: Order = None,
) -> DataFrame:
    """user_id, first_name, last_name, gender, level.

    Only ``relational`` has one row per user, with the level of the user's first play; ``lake``
    keeps a row per play and ``warehouse`` takes every event, whatever its page.
    """
    _check(variant)
    events = staged_events if variant == "warehouse" else only_plays(staged_events)
    columns = {
        "user_id": "userId", "first_name": "firstName", "last_name": "lastName",
        "gender": "gender", "level": "level",
    }
    users = [F.col(source).alias(name) for name, source in columns.items()]
    if variant == "lake":
        return events.select(*users)
    if variant == "warehouse":
        return _not_stored(events.select(*users), existing, "user_id")
    if variant == "scheduled":
        return distinct(events.select(*users))
    order = list(order_by or ["ts", "first_name", "last_name", "gender", "level"])
    return _first_per_key(existing, events.select(*users, "ts"), "user_id", order).drop("ts")


def build_time(
    source: DataFrame, existing: DataFrame | None = None, variant: str = "lake"
) -> DataFrame:
    """start_time, hour, day, week, month, year, weekday.

    ``source`` holds staged events, but the fact itself for ``scheduled``, which gets a row per
    fact row. The calendar parts follow from the time, so they are computed once duplicates are gone.
    """
    _check(variant)
    if variant == "scheduled":
        return time_parts(source.select("start_time"), base="sun0", as_text=True)
    plays = only_plays(source)
    if variant == "lake":
        return time_parts(distinct(plays.select(epoch_ms("ts").alias("start_time"))), base="sun1")
    if variant == "warehouse":
        times = distinct(plays.select(epoch_s("ts").alias("start_time")))
        return time_parts(_not_stored(times, existing, "start_time"), base="sun0")
    times = plays.select(F.col("ts").alias("start_time"))
    times = distinct(times) if existing is None else only_new(
        distinct(times), existing, ["start_time"])
    parts = time_parts(times.withColumn("__at", epoch_ms("start_time")), "__at", base="mon0")
    return parts.drop("__at")


def _play_columns(start_time: Column, session: str = "sessionId") -> list[Column]:
    return [
        start_time.alias("start_time"),
        F.col("userId").alias("user_id"),
        F.col("level"),
        F.col("song_id"),
        F.col("artist_id"),
        F.col(session).alias("session_id"),
        F.col("location"),
        F.col("userAgent").alias("user_agent"),
    ]


PLAY_ORDER = [
    "start_time", "user_id", "song_id", "artist_id", "session_id", "level", "location", "user_agent",
]
STORED_PLAY_KEY = ["user_id", "song_id", "artist_id", "start_time"]
UNIQUE_PLAY_KEY = ["start_time", "user_id", "song_id"]


def build_songplays(
    staged_events: DataFrame,
    staged_songs: DataFrame,
    existing: DataFrame | None = None,
    variant: str = "lake",
    order_by: Order = None,
    entries: DataFrame | None = None,
    rounding: str = "half_up",
    surrogate: bool = True,
    next_id: int = 1,
    number_by: Order = None,
    replicate_under: int | None = None,
    hot_share: float | None = None,
) -> DataFrame:
    """songplay_id, start_time, user_id, level, song_id, artist_id, session_id, location, user_agent
    (``lake`` adds year and month, which it is partitioned by).

    ``entries`` is the catalogue (title, artist_name, duration, song_id, artist_id) where it exists
    already. Otherwise ``lake`` and ``relational`` derive it from the song and artist dimensions,
    the other two match the staged songs. ``warehouse`` and ``relational`` number their rows from
    ``next_id`` upwards, in the order ``number_by`` or else in any order, which is cheaper;
    ``surrogate=False`` leaves the id out. ``replicate_under`` and ``hot_share`` say how a large or
    a skewed catalogue is matched (:func:`match_plays`).
    """
    _check(variant)
    if entries is None:
        entries = staged_songs
        if variant in ("lake", "relational"):
            entries = catalogue(
                build_songs(staged_songs, variant=variant),
                build_artists(staged_songs, variant=variant),
            )
    plays = only_plays(staged_events)
    return {
        "lake": _lake_plays,
        "warehouse": _warehouse_plays,
        "scheduled": _scheduled_plays,
        "relational": _relational_plays,
    }[variant](
        plays, entries, existing=existing, order=list(order_by or PLAY_ORDER), rounding=rounding,
        number=(surrogate, number_by, next_id), replicate_under=replicate_under,
        hot_share=hot_share,
    )


def _numbered(rows: DataFrame, number: tuple[bool, Order, int]) -> DataFrame:
    surrogate, number_by, next_id = number
    return surrogate_key(rows, number_by, "songplay_id", start=next_id) if surrogate else rows


def _lake_plays(plays, entries, *, order, replicate_under, hot_share, **_):
    matched = match_plays(
        plays, entries, "inner", "exact", replicate_under=replicate_under, hot_share=hot_share
    )
    # This variant stores the position in the session as session_id.
    rows = matched.select(*_play_columns(epoch_ms("ts"), session="itemInSession"))
    key = sha2_key("start_time", "user_id", "song_id", "artist_id", "session_id")
    unique = dedup(rows.withColumn("songplay_id", key), ["songplay_id"], order)
    return unique.select(
        "songplay_id", *rows.columns,
        F.year("start_time").alias("year"), F.month("start_time").alias("month"),
    )


def _warehouse_plays(plays, entries, *, existing, number, replicate_under, hot_share, **_):
    matched = match_plays(
        plays, entries, "inner", "lower", replicate_under=replicate_under, hot_share=hot_share
    )
    rows = matched.select(*_play_columns(epoch_s("ts")))
    if existing is not None:
        rows = only_new(rows, existing, STORED_PLAY_KEY, narrow=False)
    return _numbered(rows, number)


def _scheduled_plays(plays, entries, *, rounding, replicate_under, hot_share, **_):
    timed = plays.withColumn("__start", epoch_s("ts"))
    matched = match_plays(
        timed, entries, "left", "rounded", left_guard=["sessionId", "__start"],
        rounding=rounding, replicate_under=replicate_under, hot_share=hot_share,
    )
    rows = matched.select(*_play_columns(F.col("__start")))
    return rows.select(md5_key("session_id", "start_time").alias("songplay_id"), *rows.columns)


def _relational_plays(plays, entries, *, existing, order, number, replicate_under, hot_share, **_):
    # The log is matched once. A play without a song has a NULL in its unique key and conflicts with
    # nothing; stored plays are limited to the batch's time already.
    matched = match_plays(
        plays, entries, "left", "exact", first_match=True, replicate_under=replicate_under,
        hot_share=hot_share,
    )
    rows = matched.select(*_play_columns(F.col("ts")))
    return _numbered(absent_rows(existing, rows, UNIQUE_PLAY_KEY, order, narrow=False), number)
