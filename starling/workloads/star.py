"""Dimensions and facts under each set of rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import epoch_s
from ..plans import build_artists, build_songplays, build_songs, build_time, build_users
from ..plans.builders import PLAY_ORDER
from .columns import parts_sql
from .matching import EXACT, LOWER, ROUNDED, first_sql
from .stand_ins import (
    CUTOFF_MS, ENTRIES, PLAYS, REPEATED_ENTRIES, STORED_USERS, VISITS, entries, plays,
    repeated_entries, stored_users, table, visits,
)


# Dimension rows stored already: those of some names, so that at any size others remain to be added.
def _stored_songs(spark, sf):
    return table(spark, sf, "part").where("p_name < 'm'").select(F.col("p_name").alias("song_id"))


_STORED_SONGS = "SELECT p_name AS song_id FROM part WHERE p_name < 'm'"


def _stored_artists(spark, sf):
    return table(spark, sf, "part").where("p_brand < 'Brand#2'").select(
        F.col("p_brand").alias("artist_id")
    )


_STORED_ARTISTS = "SELECT p_brand AS artist_id FROM part WHERE p_brand < 'Brand#2'"


def _songs(variant):
    def query(spark, sf):
        existing = _stored_songs(spark, sf) if variant in ("warehouse", "relational") else None
        return build_songs(repeated_entries(spark, sf), existing, variant)
    return query


def _artists(variant):
    def query(spark, sf):
        existing = _stored_artists(spark, sf) if variant in ("warehouse", "relational") else None
        return build_artists(repeated_entries(spark, sf), existing, variant)
    return query


def _users(variant):
    def query(spark, sf):
        existing = stored_users(spark, sf) if variant in ("warehouse", "relational") else None
        return build_users(visits(spark, sf), existing, variant)
    return query


def _line_times(spark, sf):
    return plays(spark, sf).select("page", "ts")


def _time(variant):
    def query(spark, sf):
        events = _line_times(spark, sf)
        stored = events.where(F.col("ts") < CUTOFF_MS)
        if variant == "scheduled":
            return build_time(events.select(epoch_s("ts").alias("start_time")), variant=variant)
        existing = {
            "lake": None,
            "warehouse": stored.select(epoch_s("ts").alias("start_time")),
            "relational": stored.select(F.col("ts").alias("start_time")),
        }[variant]
        return build_time(events, existing, variant)
    return query


def _facts(variant):
    def query(spark, sf):
        log, catalogue = plays(spark, sf), entries(spark, sf)
        existing = None
        if variant in ("warehouse", "relational"):
            before = log.where(F.col("ts") < CUTOFF_MS)
            existing = build_songplays(before, catalogue, variant=variant, surrogate=False)
        return build_songplays(
            log, catalogue, existing, variant, rounding="half_up", number_by=PLAY_ORDER
        )
    return query


_SONG_TUPLE = f"SELECT song_id, title, artist_id, year, duration FROM ({REPEATED_ENTRIES})"
_ARTIST_TUPLE = f"""
  SELECT artist_id, artist_name AS name, artist_location AS location,
         TRY_CAST(artist_latitude AS DOUBLE) AS latitude,
         TRY_CAST(artist_longitude AS DOUBLE) AS longitude
  FROM ({REPEATED_ENTRIES})
"""
_USER_TUPLE = """
  userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
"""
_FIRST_ARTIST = """QUALIFY row_number() OVER (PARTITION BY artist_id
                   ORDER BY name, location, latitude NULLS FIRST, longitude NULLS FIRST) = 1"""


def _first_song(keys):
    return f"""QUALIFY row_number() OVER (PARTITION BY {keys}
               ORDER BY title, year, duration, artist_id) = 1"""


_SECOND = "make_timestamp(ts // 1000 * 1000000)"
_MS = "make_timestamp(ts * 1000)"


def _fact_sql(start, session="sessionId"):
    return f"""{start} AS start_time, userId AS user_id, level, song_id, artist_id,
               {session} AS session_id, location, userAgent AS user_agent"""


_NUMBERED = """row_number() OVER (ORDER BY start_time, user_id, song_id NULLS FIRST,
  artist_id NULLS FIRST, session_id, level, location, user_agent) AS songplay_id"""
_ALL = "start_time, user_id, level, song_id, artist_id, session_id, location, user_agent"

# The lake and relational rules match entries by the name their artist has in the dimension; here
# every artist has one name, and song ids are unique, so the entries are their own catalogue.
FACT_SQL = {
    "lake": f"""
        SELECT sha256(concat_ws('||', CAST(start_time AS VARCHAR), CAST(user_id AS VARCHAR),
                      song_id, artist_id, CAST(session_id AS VARCHAR))) AS songplay_id, *,
               CAST(extract(year FROM start_time) AS INTEGER) AS year,
               CAST(extract(month FROM start_time) AS INTEGER) AS month
        FROM (SELECT {_fact_sql(_MS, 'itemInSession')}
              FROM ({PLAYS}) p JOIN ({ENTRIES}) e ON {EXACT})
        QUALIFY row_number() OVER (PARTITION BY start_time, user_id, song_id, artist_id, session_id
                                   ORDER BY level, location, user_agent) = 1""",
    "warehouse": f"""
        WITH f AS (SELECT {_fact_sql(_SECOND)}, ts
                   FROM ({PLAYS}) p JOIN ({ENTRIES}) e ON {LOWER})
        SELECT {_NUMBERED}, {_ALL} FROM f
        WHERE NOT EXISTS (SELECT 1 FROM f s WHERE s.ts < {CUTOFF_MS} AND s.user_id = f.user_id
                          AND s.song_id = f.song_id AND s.artist_id = f.artist_id
                          AND s.start_time = f.start_time)""",
    "scheduled": f"""
        SELECT md5(CAST(session_id AS VARCHAR) || CAST(start_time AS VARCHAR)) AS songplay_id, *
        FROM (SELECT {_fact_sql(_SECOND)} FROM ({PLAYS}) p LEFT JOIN ({ENTRIES}) e ON {ROUNDED})""",
    "relational": f"""
        WITH f AS (SELECT {_fact_sql('ts')} FROM ({PLAYS}) p
                   LEFT JOIN ({first_sql('title, artist_name, duration')}) e ON {EXACT}),
             hits AS (SELECT * FROM f WHERE song_id IS NOT NULL AND NOT EXISTS (
                        SELECT 1 FROM f s WHERE s.start_time < {CUTOFF_MS}
                        AND s.start_time = f.start_time AND s.user_id = f.user_id
                        AND s.song_id = f.song_id)
                      QUALIFY row_number() OVER (PARTITION BY start_time, user_id, song_id
                        ORDER BY artist_id, session_id, level, location, user_agent) = 1)
        SELECT {_NUMBERED}, {_ALL}
        FROM (SELECT * FROM hits UNION ALL SELECT * FROM f WHERE song_id IS NULL)""",
}

QUERIES = {
    "dim_songs_lake": (_songs("lake"), f"SELECT * FROM ({_SONG_TUPLE}) "
                       + _first_song("song_id, artist_id")),
    "dim_songs_warehouse": (_songs("warehouse"), f"""
        SELECT DISTINCT * FROM ({_SONG_TUPLE}) WHERE song_id NOT IN ({_STORED_SONGS})"""),
    "dim_songs_scheduled": (_songs("scheduled"), f"""
        SELECT DISTINCT song_id, title, artist_id, year,
               CAST(duration AS DECIMAL(18,0)) AS duration FROM ({_SONG_TUPLE})"""),
    "dim_songs_relational": (_songs("relational"), f"""
        SELECT * FROM ({_SONG_TUPLE}) WHERE song_id NOT IN ({_STORED_SONGS})
        """ + _first_song("song_id")),
    "dim_artists_lake": (_artists("lake"), f"SELECT * FROM ({_ARTIST_TUPLE}) {_FIRST_ARTIST}"),
    "dim_artists_warehouse": (_artists("warehouse"), f"""
        SELECT DISTINCT * FROM ({_ARTIST_TUPLE}) WHERE artist_id NOT IN ({_STORED_ARTISTS})"""),
    "dim_artists_scheduled": (_artists("scheduled"), f"""
        SELECT DISTINCT artist_id, name, location, CAST(latitude AS DECIMAL(18,0)) AS latitude,
               CAST(longitude AS DECIMAL(18,0)) AS longitude FROM ({_ARTIST_TUPLE})"""),
    "dim_artists_relational": (_artists("relational"), f"""
        SELECT * FROM ({_ARTIST_TUPLE}) WHERE artist_id NOT IN ({_STORED_ARTISTS})
        {_FIRST_ARTIST}"""),
    "dim_users_lake": (_users("lake"), f"""
        SELECT {_USER_TUPLE} FROM ({VISITS}) WHERE page = 'NextSong'"""),
    "dim_users_warehouse": (_users("warehouse"), f"""
        SELECT {_USER_TUPLE} FROM ({VISITS}) WHERE userId NOT IN ({STORED_USERS})"""),
    "dim_users_scheduled": (_users("scheduled"), f"""
        SELECT DISTINCT {_USER_TUPLE} FROM ({VISITS}) WHERE page = 'NextSong'"""),
    "dim_users_relational": (_users("relational"), f"""
        SELECT {_USER_TUPLE} FROM ({VISITS})
        WHERE page = 'NextSong' AND userId NOT IN ({STORED_USERS})
        QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts, gender, level) = 1"""),
    "dim_time_lake": (_time("lake"), f"""
        SELECT start_time, {parts_sql('start_time', 'sun1')}
        FROM (SELECT DISTINCT {_MS} AS start_time FROM ({PLAYS}))"""),
    "dim_time_warehouse": (_time("warehouse"), f"""
        SELECT start_time, {parts_sql('start_time', 'sun0')}
        FROM (SELECT DISTINCT {_SECOND} AS start_time FROM ({PLAYS}))
        WHERE start_time NOT IN (SELECT {_SECOND} FROM ({PLAYS}) WHERE ts < {CUTOFF_MS})"""),
    "dim_time_scheduled": (_time("scheduled"), f"""
        SELECT start_time, {parts_sql('start_time', 'sun0', True)}
        FROM (SELECT {_SECOND} AS start_time FROM ({PLAYS}))"""),
    "dim_time_relational": (_time("relational"), f"""
        SELECT ts AS start_time, {parts_sql('make_timestamp(ts * 1000)', 'mon0')}
        FROM (SELECT DISTINCT ts FROM ({PLAYS}) WHERE ts >= {CUTOFF_MS})"""),
    **{f"fact_plays_{v}": (_facts(v), sql) for v, sql in FACT_SQL.items()},
}
