import datetime as dt
from decimal import Decimal

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from starling import schemas
from starling.plans import (
    VARIANTS, build_artists, build_songplays, build_songs, build_time, build_users,
)

T0 = 1541310600000  # 2018-11-04 05:50:00 UTC, a Sunday


def event(song, artist, length, user=1, session=10, item=0, ts=T0, level="free", page="NextSong"):
    return (artist, "Logged In", f"F{user}", "F", item, f"L{user}", length, level, "Here", "PUT", page,
            1.0, session, song, 200, ts, "agent", user)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [
            event("Setanta", "Elena", 269.58322, user=1, ts=T0, item=3),
            event("Setanta", "Elena", 269.58322, user=1, ts=T0, item=3),             # delivered twice
            event("SETANTA", "elena", 269.58322, user=2, ts=T0 + 100),              # other case
            event("Setanta", "Elena", 269.61000, user=3, ts=T0 + 400),              # other fraction
            event("Echo", "Twins", 100.0, user=4, ts=T0 + 2000),                     # two entries
            event("Nothing", "Nobody", 1.0, user=5, ts=T0 + 3000),                   # no entry
            event("Nothing", "Nobody", 1.0, user=5, ts=T0 + 3000),                   # again
            event("Setanta", "Elena", 269.58322, user=6, session=None, ts=T0 + 4000),
            event(None, None, None, user=1, ts=T0 + 5000, level="paid"),
            event("Echo", "Twins", 100.0, user=1, ts=T0 + 6000, level="paid"),
            event(None, None, None, user=9, ts=T0 + 7000, page="Home"),
        ],
        schemas.STAGED_EVENTS,
    )


@pytest.fixture(scope="module")
def songs(spark):
    def song(song_id, title, artist_id, name, duration, year=2000, location="X", lat=1.4):
        return (1, artist_id, lat, None, location, name, song_id, title, duration, year)
    return spark.createDataFrame(
        [
            song("S1", "Setanta", "A1", "Elena", 269.58322),
            song("S2", "Echo", "A2", "Twins", 100.0),
            song("S3", "Echo", "A3", "Twins", 100.0),
            song("S4", "Other", "A1", "Elena!", 50.5, location="Y", lat=2.6),         # two spellings
            song("S4", "Other", "A1", "Elena!", 50.5, location="Y", lat=2.6),
            song("S4", "Other (live)", "A1", "Elena!", 51.5, location="Y", lat=2.6),  # id again
        ],
        schemas.STAGED_SONGS,
    )


def test_unknown_variant(events, songs):
    for call in (lambda: build_songs(songs, variant="x"), lambda: build_time(events, variant="x")):
        with pytest.raises(ValueError):
            call()


def test_songs(spark, songs):
    stored = spark.createDataFrame([("S1",)], "song_id string")
    assert build_songs(songs).count() == 4
    assert build_songs(songs, stored, "warehouse").count() == 4     # S2 S3 S4 S4'
    assert build_songs(songs, variant="scheduled").count() == 5
    relational = rows(build_songs(songs, stored, "relational"), "song_id", "title")
    assert relational == [("S2", "Echo"), ("S3", "Echo"), ("S4", "Other")]
    durations = {r["duration"] for r in build_songs(songs, variant="scheduled").collect()}
    assert Decimal(270) in durations


def test_artists(spark, songs):
    assert rows(build_artists(songs), "artist_id", "name", "latitude") == [
        ("A1", "Elena", 1.4), ("A2", "Twins", 1.4), ("A3", "Twins", 1.4)]
    assert build_artists(songs, variant="warehouse").count() == 4
    assert build_artists(songs, variant="relational").count() == 3
    scheduled = rows(build_artists(songs, variant="scheduled"), "artist_id", "latitude", "longitude")
    assert scheduled == [("A1", Decimal(1), None), ("A1", Decimal(3), None), ("A2", Decimal(1), None),
                         ("A3", Decimal(1), None)]


def test_artist_positions_that_do_not_parse(spark):
    raw = spark.createDataFrame(
        [("A", "n", "l", v, "9") for v in ("", "abc", "12.5")],
        "artist_id string, artist_name string, artist_location string, artist_latitude string, "
        "artist_longitude string")
    assert rows(build_artists(raw, variant="warehouse"), "latitude") == [(None,), (12.5,)]


def test_users(spark, events):
    assert build_users(events).count() == 10
    assert build_users(events, variant="warehouse").count() == 11
    poisoned = spark.createDataFrame([(None,)], "user_id int")
    assert build_users(events, poisoned, "warehouse").count() == 0
    scheduled = rows(build_users(events, variant="scheduled"), "user_id", "level")
    assert [r for r in scheduled if r[0] == 1] == [(1, "free"), (1, "paid")]
    relational = rows(build_users(events, variant="relational"), "user_id", "level")
    assert relational == [(u, "free") for u in (1, 2, 3, 4, 5, 6)]
    stored = spark.createDataFrame([(1,), (2,)], "user_id int")
    assert rows(build_users(events, stored, "relational"), "user_id") == [(3,), (4,), (5,), (6,)]


def test_time(spark, events, songs):
    lake = build_time(events)
    assert lake.count() == 8 and {r["weekday"] for r in lake.collect()} == {1}
    warehouse = build_time(events, variant="warehouse")
    assert warehouse.count() == 6 and {r["weekday"] for r in warehouse.collect()} == {0}
    relational = build_time(events, variant="relational")
    assert relational.count() == 8 and {r["weekday"] for r in relational.collect()} == {6}
    assert T0 in {r["start_time"] for r in relational.collect()}
    fact = build_songplays(events, songs, variant="scheduled")
    scheduled = build_time(fact, variant="scheduled")
    assert scheduled.count() == fact.count()
    assert {(r["month"], r["weekday"]) for r in scheduled.collect()} == {("11", "0")}
    stored = spark.createDataFrame([(T0,)], "start_time bigint")
    assert build_time(events, stored, "relational").count() == 7


def test_lake_fact(events, songs):
    fact = build_songplays(events, songs)
    got = rows(fact, "user_id", "song_id", "session_id", "start_time")
    start = dt.datetime(2018, 11, 4, 5, 50)
    # The position in the session is what this variant stores as session_id.
    assert got[0] == (1, "S1", 3, start)
    assert [r[:2] for r in got] == [(1, "S1"), (1, "S2"), (1, "S3"), (4, "S2"), (4, "S3"), (6, "S1")]
    assert {(r["year"], r["month"]) for r in fact.collect()} == {(2018, 11)}
    assert fact.select("songplay_id").distinct().count() == 6


def test_warehouse_fact(spark, events, songs):
    fact = build_songplays(events, songs, variant="warehouse")
    got = rows(fact, "user_id", "song_id")
    assert got == [(1, "S1"), (1, "S1"), (1, "S2"), (1, "S3"), (2, "S1"), (3, "S1"), (4, "S2"),
                   (4, "S3"), (6, "S1")]
    assert sorted(r["songplay_id"] for r in fact.collect()) == list(range(1, 10))
    assert build_songplays(events, songs, fact, "warehouse").count() == 0
    ids = build_songplays(events, songs, variant="warehouse", next_id=100)
    assert ids.agg(F.min("songplay_id")).first()[0] == 100


def test_scheduled_fact(events, songs):
    fact = build_songplays(events, songs, variant="scheduled")
    got = sorted(rows(fact, "user_id", "song_id"), key=str)
    assert got == sorted(
        [(1, "S1"), (1, "S1"), (1, None), (1, "S2"), (1, "S3"), (2, None), (3, "S1"), (4, "S2"),
         (4, "S3"), (5, None), (5, None), (6, None)], key=str)
    by_user = {r["user_id"]: r for r in fact.collect()}
    assert by_user[6]["songplay_id"] is None
    # Two users in one session and second share an id.
    assert by_user[2]["songplay_id"] == by_user[3]["songplay_id"]


def test_scheduled_fact_truncated(events, songs):
    fact = build_songplays(events, songs, variant="scheduled", rounding="truncate")
    assert (3, "S1") in rows(fact, "user_id", "song_id")


def test_relational_fact(events, songs):
    fact = build_songplays(events, songs, variant="relational")
    got = sorted(rows(fact, "user_id", "song_id", "start_time"), key=str)
    assert got == sorted([
        (1, "S1", T0), (2, None, T0 + 100), (3, None, T0 + 400), (4, "S2", T0 + 2000),
        (5, None, T0 + 3000), (5, None, T0 + 3000), (6, "S1", T0 + 4000), (1, None, T0 + 5000),
        (1, "S2", T0 + 6000)], key=str)
    again = build_songplays(events, songs, fact, "relational")
    assert {r["song_id"] for r in again.collect()} == {None} and again.count() == 5


def test_results_do_not_depend_on_partitioning(events, songs):
    for variant in VARIANTS:
        one = build_songplays(events.coalesce(1), songs.coalesce(1), variant=variant, surrogate=False)
        many = build_songplays(events.repartition(7), songs.repartition(5), variant=variant,
                               surrogate=False)
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
        assert rows(build_artists(songs.repartition(5), variant=variant)) == rows(
            build_artists(songs.coalesce(1), variant=variant))
